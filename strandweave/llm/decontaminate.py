"""Benchmark decontamination through a distributed positional inverted index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.llm.common import cut, discard, row_key, small, words
from strandweave.llm.positional import KEY, intersect, postings, rarest_terms, term_counts, tokenized

WINDOW = 10
#: Words within which of a window's rarest term its two next rarest terms must stand for a proximity match.
NEAR = 10


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of ``benchmark`` (item_id, text): phrase_id, terms, items; to be stored before use.

    An item of fewer words, but not none, is one window.  Items without an id
    have windows too but are listed nowhere.
    """
    tokens = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w"))
    return (
        tokens.where(F.size("w") > 0)
        .select("item", "w", F.explode(F.expr(f"sequence(0, greatest(size(w) - {window}, 0))")).alias("s"))
        .select("item", F.expr(f"slice(w, s + 1, {window})").alias("terms"))
        .groupBy("terms")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .select(F.monotonically_increasing_id().alias("phrase_id"), "terms", "items")
    )


def matches(tokens: DataFrame, benchmark: DataFrame, window: int = WINDOW, near: int = NEAR) -> DataFrame:
    """Exact phrase and proximity matches of ``benchmark`` windows in ``tokens``, as ``tokenized`` makes them.

    One row per document and window that match: row_hash, row_chars, items
    (the window's), spans (s and e, end exclusive, of each exact occurrence)
    and near (the places of the window's rarest term with its two next rarest
    terms within ``near`` words; null for windows of fewer terms).  The lists'
    meeting places are checked word by word in the documents that hold any.
    """
    phrases = cut(windows(benchmark, window))
    vocabulary = phrases.select(F.explode("terms").alias("term")).distinct()
    ranked = cut(rarest_terms(phrases, term_counts(tokens, vocabulary)))
    index = postings(tokens, ranked.select(F.explode("anchors.term").alias("term")).distinct())
    met = intersect(index, ranked.select("phrase_id", "anchors"), near)
    held = [F.col(c).alias(f"m_{c}") for c in KEY]
    met = cut(met.groupBy(*held).agg(F.collect_list(F.struct("phrase_id", "exact", "near")).alias("met")))
    there = f"transform(m.exact, s -> named_struct('s', s, 'w', slice(words, s + 1, {window})))"
    candidates = (
        tokens.join(small(met), [F.col(c) == F.col(f"m_{c}") for c in KEY])
        .select(*KEY, F.inline(F.expr(f"transform(met, m -> named_struct('p', m.phrase_id, 'near', m.near, 'there', {there}))")))
    )
    spans = "transform(filter(there, x -> slice(x.w, 1, size(terms)) = terms), x -> named_struct('s', x.s, 'e', x.s + size(terms)))"
    return candidates.join(small(phrases), F.col("p") == F.col("phrase_id")).select(*KEY, "items", F.expr(spans).alias("spans"), "near")


def judge(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items.

    ``n_hit`` counts the words inside any occurrence of a window.
    ``n_near_items`` counts the items with an exact or proximity match.  Null
    has no words.  Rows with the same doc_id and text have the same result,
    once for each of them.  An empty benchmark leaves all clean.
    """
    tokens = tokenized(docs)
    items = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    exact = F.size("spans") > 0
    found = (
        matches(tokens, benchmark, window)
        .groupBy(*[F.col(c).alias(f"f_{c}") for c in KEY])
        .agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
            items(F.when(exact, F.col("items"))).alias("items"),
            items(F.when(exact | (F.size("near") > 0), F.col("items"))).alias("near"),
        )
    )
    covered = """aggregate(spans, named_struct('e', 0, 'n', 0),
        (a, x) -> named_struct('e', greatest(a.e, x.e), 'n', a.n + greatest(x.e - greatest(a.e, x.s), 0)),
        a -> cast(a.n as bigint))"""
    n = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0)).cast("long")
    rows = tokens.select("doc_id", *KEY, F.size("words").cast("long").alias("n_words"))
    return (
        rows.join(small(cut(found)), [F.col(c) == F.col(f"f_{c}") for c in KEY], "left")
        .withColumn("n_hit", F.coalesce(F.expr(covered), F.lit(0)).cast("long"))
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            n("items").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
            (F.col("n_hit") > 0).alias("contaminated"),
            n("near").alias("n_near_items"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without an occurrence of a window, with all their columns.

    Rows with a null doc_id or text are rows like others; a null text is clean.
    """
    tokens = tokenized(docs)
    found = matches(tokens, benchmark, window).where("size(spans) > 0")
    hit = cut(found.select(F.col("row_hash").alias("__sw_hash"), F.col("row_chars").alias("__sw_chars")).distinct())
    discard(tokens)  # all that follows goes by the hits
    key, chars = row_key("doc_id", "text")
    return docs.join(small(hit), key.eqNullSafe(F.col("__sw_hash")) & chars.eqNullSafe(F.col("__sw_chars")), "left_anti")
