"""A positional inverted index over documents, in DataFrame operations only.

Texts are split into words once and stored.  Terms are counted over all of
them, and for the rarest terms of each phrase the postings are stored: term,
document, places.  A phrase is looked up from its rarest term's list on; the
lists of the next ones, less their places in the phrase, are intersected with
it within each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.llm.common import cut, row_key, small, stored, words

#: Terms of a phrase whose lists are intersected.
ANCHORS = 3
KEY = ["row_hash", "row_chars"]


def tokenized(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, row_chars (the row's key) and words of each row of ``docs`` (doc_id, text), stored."""
    return stored(docs.select("doc_id", *row_key("doc_id", "text"), words(F.col("text")).alias("words")), "tokens")


def term_counts(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """How often each term of ``vocabulary`` (term) stands in ``tokens`` (words); terms that never do are absent."""
    return tokens.select(F.explode("words").alias("term")).join(small(vocabulary), "term").groupBy("term").agg(F.count(F.lit(1)).alias("postings"))


def rarest_terms(phrases: DataFrame, counts: DataFrame, keep: int = ANCHORS) -> DataFrame:
    """Adds ``anchors``: up to ``keep`` of each phrase's terms with their places, rarest first.

    ``phrases`` has ``phrase_id`` and ``terms``.  A phrase with a term that no
    document holds can't occur and goes.
    """
    by_term = (
        phrases.select("phrase_id", F.size("terms").alias("n"), F.posexplode("terms").alias("at", "term"))
        .join(small(cut(counts)), "term")
        .groupBy("phrase_id", "n")
        .agg(F.array_sort(F.collect_list(F.struct("postings", "at", "term"))).alias("ranked"))
        .where(F.size("ranked") == F.col("n"))
        .select("phrase_id", F.slice("ranked", 1, keep).alias("anchors"))
    )
    return phrases.join(by_term, "phrase_id")


def postings(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """The inverted index of ``terms`` (term): term, row_hash, row_chars, places; one row per term and document, stored.

    A term's list so has as many rows as documents hold it, and a term that
    most documents hold is split between tasks.
    """
    each = tokens.select(*KEY, F.posexplode("words").alias("at", "term")).join(small(terms), "term")
    return stored(each.groupBy("term", *KEY).agg(F.sort_array(F.collect_set("at")).alias("places")), "postings")


def intersect(index: DataFrame, phrases: DataFrame, near: int) -> DataFrame:
    """Where the rarest terms of ``phrases`` (phrase_id, anchors) meet in a document: KEY, phrase_id, exact, near.

    ``exact`` holds the starts that the lists of all of a phrase's anchors
    agree on, ``near`` the places of the rarest anchor with each of the others
    within ``near`` words; it is null for phrases of fewer terms than ANCHORS.
    Phrases that share their anchors, at the same distances, are looked up
    together, as one probe.
    """
    anchor = lambda k: F.get("anchors", F.lit(k))
    names = [f"t{k}" for k in range(ANCHORS)] + [f"d{k}" for k in range(1, ANCHORS)]
    probe = [anchor(k)["term"].alias(f"t{k}") for k in range(ANCHORS)]
    probe += [(anchor(k)["at"] - anchor(0)["at"]).alias(f"d{k}") for k in range(1, ANCHORS)]
    keyed = phrases.select("phrase_id", anchor(0)["at"].alias("first"), *probe)
    probes = cut(keyed.select(*names).distinct().withColumn("probe", F.monotonically_increasing_id()))
    found = index.join(small(probes), F.col("term") == F.col("t0"))
    found = found.select(*KEY, "probe", F.col("places").alias("exact"), F.lit(None).cast("array<int>").alias("near"))
    for k in range(1, ANCHORS):
        own = probes.select(F.col("probe").alias("p"), F.col(f"t{k}").alias("t"), F.col(f"d{k}").alias("d"))
        found = found.join(small(own), F.col("probe") == F.col("p"))
        terms = small(own.where("t is not null").select(F.col("t").alias("u")).distinct())
        other = index.join(terms, F.col("term") == F.col("u"), "left_semi")
        other = other.select(F.col("term").alias("other"), *[F.col(c).alias(f"o_{c}") for c in KEY], F.col("places").alias("more"))
        found = found.join(other, [F.col("t") == F.col("other"), *[F.col(c) == F.col(f"o_{c}") for c in KEY]], "left")
        around = F.expr(f"flatten(transform(more, y -> sequence(y - {near}, y + {near})))")
        none, before = F.col("t").isNull(), F.col("exact") if k == 1 else F.col("near")
        found = found.select(
            *KEY,
            "probe",
            F.when(none, F.col("exact")).otherwise(F.array_intersect("exact", F.expr("transform(more, y -> y - d)"))).alias("exact"),
            F.when(~none, F.array_intersect(before, around)).alias("near"),
            "t",
        ).where("t is null or size(exact) > 0 or size(near) > 0").drop("t")
    same = [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in names]
    own = keyed.join(small(probes.select("probe", *[F.col(c).alias(f"p_{c}") for c in names])), same).select("phrase_id", "first", F.col("probe").alias("p"))
    starts = F.filter(F.transform("exact", lambda x: x - F.col("first")), lambda x: x >= 0)
    return found.join(small(cut(own)), F.col("probe") == F.col("p")).select(*KEY, "phrase_id", starts.alias("exact"), "near")
