"""Secret scans: fixed patterns, and character Markov models of random strings and ordinary identifiers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The patterns of each kind, in the order in which kinds are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # as long runs: what AKIA[A-Z0-9]+ finds of 20 characters and more
HEX = r"[0-9a-f]{24,}"  # as long runs: what [0-9a-f]+ finds of 24 characters and more
KINDS = ["assign", "access", "hex"]
LEAST_VALUE = 6
#: What the models judge: runs of at least 16 of these characters, outside base spans, with a digit or several capitals
#: after small letters.
RUN = r"[A-Za-z0-9+/_=-]{16,}"
ODD = "[0-9]|[a-z][A-Z].*[a-z][A-Z]"
#: The models' alphabet is the code points from "+" to "z".
LOW, WIDTH = ord("+"), ord("z") - ord("+") + 1
#: A run is a secret if the mean log-likelihood ratio of its character pairs is above this.
LEAST_RATIO = 0.8
#: Labelled samples of each class; the rule that makes them is the labelling.
SAMPLES = 3000
SMOOTHING = 0.5
#: Code points of the chunks from which a text without its secrets is put together.
CHUNK = 1024
#: Parts of ordinary identifiers.
PARTS = "account add api array auth backup batch block book box buffer button call category chapter check class client code column common content control count current data date delete detail dialog document download edit email entity error example feature figure filter first footer frame gallery global guide header history image index input instance item key language layout library line list local login manager master member message mobile module name news note object option output package panel part path photo player point post print process profile project query record report research response review root sample school screen search security send server session share single size space start static storage story string summary switch table task template test theme title tool total train update user version view web widget work year".split()


def labelled_samples(spark: SparkSession, n: int = SAMPLES, first: int = 0) -> DataFrame:
    """``n`` random strings and ``n`` ordinary identifiers (sample, random), by rule from the numbers from ``first`` on."""
    parts = F.lit(" ".join(PARTS))
    at = spark.range(first, first + n).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    b64 = F.rtrim(F.base64(F.unhex("h")), F.lit("="))
    plain, number = F.regexp_replace(b64, "[+/]", ""), F.conv(F.substring("h", 60, 2), 16, 10).cast("int")
    random = F.element_at(
        F.array(
            b64,
            F.substring("h", 1, 40),
            F.translate(b64, "+/", "-_"),
            F.upper(F.substring(plain, 1, 24)),
            F.substring(plain, F.lit(1), 16 + number % 8),
            F.substring(F.regexp_replace(plain, "[0-9]", ""), 1, 20),
        ),
        (F.col("id") % 6 + 1).cast("int"),
    )
    part = lambda k: F.element_at(
        F.split(parts, " "), (F.conv(F.substring("h", k, 4), 16, 10).cast("int") % len(PARTS) + 1).cast("int")
    )
    year = (F.lit(1990) + number % 40).cast("string")
    month = F.lpad((number % 12 + 1).cast("string"), 2, "0")
    a, b, c, d = (part(k) for k in (1, 5, 9, 13))
    ordinary = F.element_at(
        F.array(
            F.concat_ws("_", a, b, c, number.cast("string")),
            F.concat_ws("-", a, b, c, d, year),
            F.concat(a, F.initcap(b), F.initcap(c), F.initcap(d), number.cast("string")),
            F.concat_ws("/", a, year, month, b, c),
            F.concat(F.upper(a), F.lit("_"), F.upper(b), F.lit("_"), F.upper(c), F.lit("_"), month),
            F.concat(a, F.lit("-"), year, F.lit("-"), month, F.lit("-"), b, F.lit("="), c),
        ),
        (F.col("id") % 6 + 1).cast("int"),
    )
    return at.select(random.alias("sample"), F.lit(True).alias("random")).unionByName(
        at.select(ordinary.alias("sample"), F.lit(False).alias("random"))
    )


def train(samples: DataFrame, smoothing: float = SMOOTHING) -> list[float]:
    """Log-likelihood ratios of the pairs of alphabet characters, random over ordinary, as one list of WIDTH * WIDTH.

    What comes to the driver is a count for each pair at most, whatever the
    number of samples (sample, random).  Null samples count for nothing.
    """
    code = lambda k: F.ascii(F.substring("sample", k, 1)) - LOW
    pairs = (
        samples.where("length(sample) > 1")
        .select("random", "sample", F.explode(F.expr("sequence(1, length(sample) - 1)")).alias("k"))
        .select("random", code(F.col("k")).alias("a"), code(F.col("k") + 1).alias("b"))
        .where(f"a between 0 and {WIDTH - 1} and b between 0 and {WIDTH - 1}")
        .groupBy("random", "a", "b")
        .count()
        .collect()
    )
    counts = {True: {}, False: {}}
    sums = {True: {}, False: {}}
    for r in pairs:
        counts[r["random"]][r["a"], r["b"]] = r["count"]
        sums[r["random"]][r["a"]] = sums[r["random"]].get(r["a"], 0) + r["count"]
    chance = lambda kind, a, b: (counts[kind].get((a, b), 0) + smoothing) / (sums[kind].get(a, 0) + smoothing * WIDTH)
    return [round(math.log(chance(True, a, b) / chance(False, a, b)), 5) for a in range(WIDTH) for b in range(WIDTH)]


def ratio(run: Column, model: list[float]) -> Column:
    """The mean log-likelihood ratio of a run's character pairs."""
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")
    code = lambda k: F.ascii(F.substring(run, k, 1)) - LOW
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(run) - 1), F.lit(0.0), lambda s, k: s + F.get(table, code(k) * WIDTH + code(k + 1))
    )
    return total / (F.length(run) - 1)


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, step) -> Column:
    """For each of ``values`` (ints of at least 0) the fold by ``step``, sums or maxima, of those before it.

    Goes by blocks of the square root of their number, since an array that is
    appended to is copied each time.
    """
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def fold(xs: Column) -> Column:
        return F.aggregate(xs, start, lambda acc, x: F.struct(step(acc["at"], x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")))

    def joined(blocks: Column) -> Column:
        before = fold(F.transform(blocks, lambda x: x["at"]))["out"]
        return F.flatten(F.zip_with(before, blocks, lambda at, x: F.transform(x["out"], lambda y: step(at, y))))

    def run(xs: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(xs))).cast("int"), F.lit(1))
        last = F.floor((F.greatest(F.size(xs), F.lit(1)) - 1) / width).cast("int")
        return _let(F.transform(F.sequence(F.lit(0), last), lambda b: fold(F.slice(xs, b * width + 1, width))), joined)

    return _let(values, run)


def _found(text: Column, pattern: str, kind: str) -> Column:
    """All matches as an array of (s, o, e, kind, hit): start, place of the kind, end, matched text.

    The pieces between the matches tell where each match lies.
    """
    order = (KINDS + ["markov"]).index(kind)
    empty = F.array().cast("array<struct<s:int,o:int,e:int,kind:string,hit:string>>")
    hits, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def placed(pairs: Column) -> Column:
        before = _running(F.transform(pairs, lambda x: x["gap"] + F.coalesce(F.length(x["h"]), F.lit(0))), lambda a, b: a + b)
        return F.zip_with(
            pairs,
            before,
            lambda x, at: F.struct(
                (at + x["gap"]).alias("s"),
                F.lit(order).alias("o"),
                (at + x["gap"] + F.length(x["h"])).alias("e"),
                F.lit(kind).alias("kind"),
                x["h"].alias("hit"),
            ),
        )

    spans = _let(F.zip_with(hits, pieces, lambda h, p: F.struct(h.alias("h"), F.length(p).alias("gap"))), placed)
    return F.when(text.rlike(pattern), F.filter(spans, lambda x: x["hit"].isNotNull())).otherwise(empty)


def _is_base(hit: Column, kind: str) -> Column:
    return F.length(F.regexp_extract(hit, ASSIGN, 2)) >= LEAST_VALUE if kind == "assign" else F.lit(True)


def _blanked(text: Column, pattern: str, kind: str) -> Column:
    """``text`` with blanks in place of its base spans of this kind, so that all else stays in its place."""
    hits, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    over = lambda h: F.when(_is_base(h, kind), F.repeat(F.lit(" "), F.length(h))).otherwise(h)
    joined = F.array_join(F.zip_with(pieces, hits, lambda p, h: F.concat(p, F.coalesce(over(h), F.lit("")))), "")
    return F.when(text.rlike(pattern), joined).otherwise(text)


def with_spans(docs: DataFrame, model: list[float] | None = None, least: float = LEAST_RATIO) -> DataFrame:
    """``docs`` with ``__sw_base`` and ``__sw_spans``, sorted arrays of (s, o, e, kind, hit) in code points, end exclusive.

    ``__sw_spans`` adds to the base spans the runs that the models take for
    random strings (kind markov).  Runs are found in the text whose spans of
    the first kind, then of the second, then of the third are blanked, so that
    what is left of a longer string beside a base span is judged by itself.
    Null text holds nothing; each row is judged by itself, so repeated rows
    have the same result and an empty table has none; other columns stay.
    The time grows with the length of a text and the number of its matches
    times its square root.
    """
    model = model or train(labelled_samples(docs.sparkSession))
    text = F.coalesce("text", F.lit(""))
    kinds = list(zip((ASSIGN, ACCESS, HEX), KINDS, strict=True))
    base = [_found(text, p, k) for p, k in kinds]
    base[0] = F.filter(base[0], lambda x: _is_base(x["hit"], "assign"))
    out = docs.withColumn("__sw_base", F.array_sort(F.concat(*base))).withColumn("__sw_rest", text)
    for p, k in kinds:  # few texts hold any
        held = F.expr(f"exists(__sw_base, x -> x.kind = '{k}')")
        out = out.withColumn("__sw_rest", F.when(held, _blanked(F.col("__sw_rest"), p, k)).otherwise(F.col("__sw_rest")))
    rest = F.col("__sw_rest")
    more = F.filter(_found(rest, RUN, "markov"), lambda x: x["hit"].rlike(ODD) & (ratio(x["hit"], model) > least))
    return out.withColumn("__sw_spans", F.array_sort(F.concat("__sw_base", F.when(rest.rlike(RUN), more).otherwise(F.array())))).drop("__sw_rest")


def _text_of(spans: str) -> Column:
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ","
    )


def scan(docs: DataFrame, model: list[float] | None = None, least: float = LEAST_RATIO) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Null text is empty and holds nothing.  Repeated rows have the same result,
    an empty table has none, and further columns stay out, whatever their names.
    """
    n = lambda kind: F.size(F.filter("__sw_base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return with_spans(docs.select("doc_id", "text"), model, least).select(
        "doc_id", *[n(k) for k in KINDS], F.sha2(_text_of("__sw_base"), 256).alias("base_sha256"), _text_of("__sw_spans").alias("spans")
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", model: list[float] | None = None, least: float = LEAST_RATIO) -> DataFrame:
    """``docs`` with all their columns, every secret in ``text`` replaced by ``mark``, and ``n_chars`` renewed if there."""
    chunks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))

    def part(of: Column, a: Column, b: Column) -> Column:
        """Code points a to b, end exclusive; a substring of the whole text would be counted off from its start."""
        i, j = F.floor(a / CHUNK).cast("int"), F.floor((b - 1) / CHUNK).cast("int")
        head, tail = F.get(of, i), F.get(of, j)
        return F.when(a >= b, "").when(i == j, F.substring(head, a - i * CHUNK + 1, b - a)).otherwise(
            F.concat(F.substring(head, a - i * CHUNK + 1, F.lit(CHUNK)), F.array_join(F.slice(of, i + 2, F.greatest(j - i - 1, F.lit(0))), ""), F.substring(tail, F.lit(1), b - j * CHUNK))
        )

    def clean(of: Column) -> Column:
        before = _running(F.transform("__sw_spans", lambda x: x["e"]), F.greatest)
        marked = F.zip_with("__sw_spans", before, lambda x, at: F.when(x["s"] >= at, F.concat(part(of, at, x["s"]), F.lit(mark))).otherwise(""))
        return F.concat(F.array_join(marked, ""), part(of, F.array_max(F.transform("__sw_spans", lambda x: x["e"])), F.length("text")))

    out = with_spans(docs, model, least).withColumn("text", F.when(F.size("__sw_spans") > 0, _let(chunks, clean)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("__sw_spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
