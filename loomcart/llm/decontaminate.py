"""Benchmark decontamination by a positional inverted index.

The index holds a posting (row, term, position) for every training word that is a term of
the test set, and one posting of term 0 per row whose position is the row's length. Test
phrases are looked up from their rarest term: its postings, moved back by the term's
offset, are candidate starts; the lists of the further terms, moved likewise, are
intersected with them, the second rarest first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomcart.llm.common import checked_broadcast, lower_ascii, stored, text_hash, words

WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WINDOW_WORDS = 13
HIT_SHARE = 20  # contaminated: one word in so many is hit


def test_windows(items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """window_id, item_id, terms: every ``size`` consecutive words of an item; the whole of
    a shorter one. Equal windows share their id. Items without words have none."""
    split = items.select("item_id", words(lower_ascii(F.col("text")), WORDS).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    each = split.select("item_id", "w", F.explode(starts).alias("i")).select(
        "item_id", F.slice("w", F.col("i") + 1, size).alias("terms"))
    return each.distinct().withColumn("window_id", F.sha2(F.concat_ws(" ", "terms"), 256))


def build_index(docs: DataFrame, terms: DataFrame, n_terms: int) -> DataFrame:
    """row_id, doc_id, text_hash, term_id, pos: the postings of ``terms`` (term, term_id >
    0) in ``docs``, stored, with a posting of term 0 at the length of every row. doc_id and
    text_hash are held by the latter only. Rows are numbered, so repeated doc_ids stay
    apart."""
    split = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id",
                        text_hash(F.col("text")).alias("text_hash"),
                        words(lower_ascii(F.col("text")), WORDS).alias("w"))
    each = split.select("row_id", "doc_id", "text_hash", F.posexplode(F.concat("w", F.array(F.lit("")))).alias("pos", "term"))
    known = terms.select("term", "term_id").union(
        terms.sparkSession.createDataFrame([("", 0)], "term string, term_id int"))
    joined = each.join(checked_broadcast(known, n_terms), "term")
    length = F.col("term_id") == 0
    return stored(joined.select("row_id", F.when(length, F.col("doc_id")).alias("doc_id"),
                                F.when(length, F.col("text_hash")).alias("text_hash"), "term_id", "pos"), "postings")


def lookup(index: DataFrame, phrases: DataFrame, reach: int = 0) -> DataFrame:
    """row_id, phrase_id, start of every occurrence of ``phrases`` (phrase_id, offset,
    term_id; one row per word). With ``reach`` > 0, proximity: every further term may
    stand up to so many words before or after its place beside the rarest; the start is
    then counted from the rarest term and may lie before the row.

    The list of the rarest term gives the candidates. The second rarest cuts them down;
    the rest are intersected in one step, which each candidate has to pass for every term.
    """
    counts = index.where("term_id > 0").groupBy("term_id").count()
    lengths = phrases.groupBy("phrase_id").agg(F.count(F.lit(1)).alias("n"))
    # A phrase with a term that never occurs has no occurrence.
    by_rarity = Window.partitionBy("phrase_id").orderBy("count", "term_id", "offset")
    whole = Window.partitionBy("phrase_id")
    ranked = (phrases.join(counts, "term_id").join(lengths, "phrase_id")
              .withColumn("rank", F.row_number().over(by_rarity))
              .withColumn("found", F.count(F.lit(1)).over(whole)).where("found = n")
              .select("phrase_id", "offset", "term_id", "rank", "n"))
    ranked = stored(ranked, "phrases")
    n_rows = ranked.count()
    postings = index.where("term_id > 0").select("row_id", "term_id", "pos")

    def list_of(condition: str) -> DataFrame:
        """Postings of the terms asked for only."""
        asked = ranked.where(condition).select("term_id").distinct()
        return postings.join(checked_broadcast(asked, n_rows), "term_id", "left_semi")

    rarest = ranked.where("rank = 1").select("phrase_id", "offset", "term_id", "n")
    found = stored(
        postings.join(checked_broadcast(rarest, n_rows), "term_id")
        .select("row_id", "phrase_id", (F.col("pos") - F.col("offset")).alias("start"), "n")
        .where("start >= 0" if reach == 0 else "true"), "candidates")

    shifts = F.sequence(F.lit(-reach), F.lit(reach))

    def intersect(found: DataFrame, condition: str) -> DataFrame:
        """Candidates for which every term of the ranks asked for stands at its place."""
        asked = ranked.where(condition).select("phrase_id", "offset", "term_id")
        places = found.join(checked_broadcast(asked, n_rows), "phrase_id").select(
            "row_id", "phrase_id", "start", "n", "term_id", "offset",
            (F.col("start") + F.col("offset")).alias("at"))
        places = places.withColumn("pos", F.explode(F.transform(shifts, lambda s: F.col("at") + s))) \
            if reach else places.withColumnRenamed("at", "pos")
        rows = found.select("row_id").distinct()
        lists = list_of(condition).join(checked_broadcast(rows, rows.count()), "row_id", "left_semi")
        met = places.join(lists, ["row_id", "term_id", "pos"])
        if reach:
            met = met.dropDuplicates(["row_id", "phrase_id", "start", "offset"])
        passed = met.groupBy("row_id", "phrase_id", "start", "n").agg(F.count(F.lit(1)).alias("terms"))
        asked_n = asked.groupBy("phrase_id").agg(F.count(F.lit(1)).alias("asked"))
        none = found.join(checked_broadcast(asked_n, n_rows), "phrase_id", "left_anti")
        return (passed.join(checked_broadcast(asked_n, n_rows), "phrase_id").where("terms = asked")
                .select("row_id", "phrase_id", "start", "n").unionByName(none))

    found = stored(intersect(found, "rank = 2"), "candidates")
    return intersect(found, "rank > 2").withColumnRenamed("n", "length")


def number_terms(windows: DataFrame) -> DataFrame:
    """term, term_id (from 1) for every distinct term. Numbered in one task: the terms of
    the test set, whose bound is the number of its words."""
    terms = windows.select(F.explode("terms").alias("term")).distinct()
    return terms.withColumn("term_id", F.row_number().over(Window.orderBy("term")))


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS, hit_share: int = HIT_SHARE) -> DataFrame:
    """One row per row of ``docs``: row_id, doc_id, text_hash, n_words, n_hit, n_items, items (those
    with an occurring window, sorted as strings), items_sha256, contaminated.

    A word is hit if it lies in an occurrence of a window; a row is contaminated if at
    least one word in ``hit_share`` is hit. Null and empty texts have no words and are
    clean; so is everything if there are no items. Null item_ids are left out of items.
    Repeated rows are judged one by one. Other columns are not read.
    """
    windows = stored(test_windows(items, size), "windows")
    terms = stored(number_terms(windows), "terms")
    index = build_index(docs, terms, terms.count())
    phrases = (windows.select("window_id", "terms").distinct()
               .select(F.col("window_id").alias("phrase_id"), F.posexplode("terms").alias("offset", "term"))
               .join(terms, "term").select("phrase_id", "offset", "term_id"))
    matches = stored(lookup(index, phrases), "matches")
    # Words covered by the union of the matches of a row, from left to right.
    earlier = (Window.partitionBy("row_id").orderBy("start", "length")
               .rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("start") + F.col("length")
    spans = matches.select("row_id", "start", "length").distinct().withColumn(
        "reached", F.coalesce(F.max(end).over(earlier), F.lit(0)))
    hits = spans.groupBy("row_id").agg(
        F.sum(F.greatest(F.lit(0), end - F.greatest("start", "reached"))).cast("long").alias("n_hit"))
    owners = windows.select(F.col("window_id").alias("phrase_id"), F.col("item_id").cast("string").alias("item"))
    met = matches.select("row_id", "phrase_id").distinct().join(owners, "phrase_id")
    named = met.groupBy("row_id").agg(F.array_sort(F.collect_set("item")).alias("items"))
    rows = index.where("term_id = 0").select("row_id", "doc_id", "text_hash", F.col("pos").cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    found = F.coalesce("items", F.array().cast("array<string>"))
    return (rows.join(hits, "row_id", "left").join(named, "row_id", "left")
            .select("row_id", "doc_id", "text_hash", "n_words", n_hit.alias("n_hit"),
                    F.size(found).cast("long").alias("n_items"), found.alias("items"),
                    F.sha2(F.array_join(found, ","), 256).alias("items_sha256"),
                    ((n_hit > 0) & (hit_share * n_hit >= F.col("n_words"))).alias("contaminated")))
