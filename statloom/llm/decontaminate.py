"""Finds and removes passages of a benchmark in documents. Column expressions only.

A window is ``size`` consecutive words of an item, or all words of a shorter item. The 64-bit hashes of the
windows are a set that every executor holds; each place of a document is looked up in it. What is met there is
a hit only if its words are those of a window, which a join of the hits, few as they are, with the windows
tells. The set is split into blocks of about ``BLOCK_WINDOWS`` hashes, so what is broadcast has a bound in
bytes, however large the benchmark, its words and the number of items that share a window are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.shared import free_name, words_of, written

SIZE = 10
#: Hashes of one broadcast block: some 64 bytes each in a hash set of Spark's.
BLOCK_WINDOWS = 1_000_000


def windows(benchmark: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """A row per distinct window and item: hash, length, words as one string, item."""
    words = (benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words"))
             .where(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(size))))
    places = words.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)))
    grams = places.select("item", "length", F.slice("words", F.col("at"), F.col("length")).alias("gram"))
    return grams.select(F.xxhash64("gram").alias("hash"), "length", F.array_join("gram", " ").alias("gram"), "item").distinct()


def _met(docs: DataFrame, block: DataFrame, lengths: list[int], with_rows: bool) -> DataFrame:
    """A row per place of a document whose hash is in the block; and, ``with_rows``, one at -1 per document."""
    kinds, low = len(lengths), -1 if with_rows else 0
    rows = docs.withColumn("n_words", F.size("words")).where((F.lit(low) < 0) | (F.col("n_words") > 0)).withColumn(
        "i", F.explode(F.sequence(F.lit(low), F.size("words") * kinds - 1)))
    at = F.floor(F.col("i") / kinds).cast("int") if kinds > 1 else F.col("i")
    length = (F.element_at(F.array(*map(F.lit, lengths)), F.pmod(F.col("i"), F.lit(kinds)) + 1)
              if kinds > 1 else F.lit(lengths[0]))
    rows = rows.withColumn("at", at).withColumn("span", length)
    fits = (F.col("i") >= 0) & (F.col("at") + F.col("span") <= F.col("n_words"))
    gram = F.slice("words", F.greatest(F.col("at") + 1, F.lit(1)), F.col("span"))
    rows = rows.where((F.col("i") < 0) | fits).withColumn("probe", F.when(fits, F.xxhash64(gram)))
    found = rows.join(F.broadcast(block), F.col("probe") == F.col("hash"), "left")
    met = F.col("hash").isNotNull()
    return found.where((F.col("i") < 0) | met).select(
        "k1", "k2", F.when(~met, F.col("id")).alias("id"), "n_words", F.when(met, F.col("at")).alias("start"),
        F.when(met, F.col("span")).alias("length"), "hash", F.when(met, F.array_join(gram, " ")).alias("gram"))


def _merged(places: Column) -> Column:
    """Sorted places as disjoint spans."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(done, place):
        last = F.element_at(done, -1)
        joined = F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], place["end"]).alias("end"))))
        return (F.when(F.size(done) == 0, F.array(place))
                .when(place["start"] <= last["end"], joined).otherwise(F.concat(done, F.array(place))))

    return F.aggregate(F.array_sort(F.array_distinct(places)), empty, step)


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", size: int = SIZE) -> DataFrame:
    """Per document: ``id_col``, n_words, spans (disjoint word spans from 0 that windows cover), items.

    A null or empty text has no words, no spans and no items; so has every text when the benchmark is
    empty. Each input row gives one row, also when ids repeat or are null: rows are known by two hashes of id
    and text, and equal ones are counted. Other columns are left out, so their names cannot clash. Ties cannot
    arise: all windows count. Long texts are scanned whole; a document is one row of the shuffle, with its hits.
    """
    grams = written(windows(benchmark, item_col, item_text, size), "windows")
    facts = grams.groupBy("length").agg(F.approx_count_distinct("hash").alias("n")).collect()  # at most ``size`` rows
    lengths, total = sorted(r["length"] for r in facts) or [size], sum(r["n"] for r in facts)
    text = F.coalesce(F.col(text_col), F.lit(""))
    known = [F.col(id_col), F.isnull(id_col), text]
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(*known).alias("k1"), F.xxhash64(F.lit(1), *known).alias("k2"),
                       words_of(F.col(text_col)).alias("words"))
    blocks, met = max(1, -(-total // BLOCK_WINDOWS)), None
    for k in range(blocks):
        part = grams.select("hash").distinct()
        part = part if blocks == 1 else part.where(F.pmod(F.xxhash64("hash"), F.lit(blocks)) == k)
        more = _met(base, part, lengths, k == 0)
        met = more if met is None else met.unionByName(more)
    met, key = written(met, "met"), ["k1", "k2"]
    rows = met.where("hash is null").groupBy(*key).agg(
        F.first("id").alias("id"), F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("copies"))
    gram = ["hash", "length", "gram"]
    # Copies of a document share their places, so each place counts once.
    hits = met.where("hash is not null").select(*key, "start", *gram).distinct().join(grams.select(gram).distinct(), gram)
    hits = written(hits, "hits")
    place = F.struct("start", (F.col("start") + F.col("length")).alias("end"))
    spans = hits.groupBy(*key).agg(F.collect_list(place).alias("places"))
    items = hits.select(*key, *gram).distinct().join(grams, gram).select(*key, "item").distinct()
    items = items.groupBy(*key).agg(F.array_sort(F.collect_list("item")).alias("items"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    made = rows.join(spans, key, "left").join(items, key, "left").withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return made.select(
        F.col("id").alias(id_col), F.col("n_words").cast("long").alias("n_words"), _merged(F.coalesce("places", none)).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def words_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def remove_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     size: int = SIZE) -> DataFrame:
    """The documents, with all their columns, in which no window of the benchmark stands.

    Rows are told apart by id and a hash of the text: repeated rows are judged alike. Null and empty
    texts stay. All windows count, so there are no ties; texts of any length are scanned whole. Other columns
    may have any names. An empty table stays one, and an empty benchmark keeps every row.
    """
    key = [F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.xxhash64(F.col(text_col))]
    keyed = docs.select(F.struct(key[0].alias("a"), key[1].alias("b")).alias("id"), F.col(text_col).alias("text"))
    bad = scan(keyed, benchmark, "id", "text", size=size).where(F.size("items") > 0).select("id").distinct()
    name = free_name(docs, "_scan_key")
    named = docs.withColumn(name, F.struct(key[0].alias("a"), key[1].alias("b")))
    return named.join(bad.withColumnRenamed("id", name), name, "left_anti").drop(name)


def remove_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 size: int = SIZE) -> DataFrame:
    """``id_col`` and ``text_col`` with the words of all spans cut out; what stands around words stays.

    Null and clean texts are given back as they are. One row per input row.
    """
    rows = docs.select(F.struct(F.col(id_col).alias("id"), F.col(text_col).alias("text")).alias("id"),
                       F.col(text_col).alias("text"))
    spans = scan(rows, benchmark, "id", "text", size=size)
    text = F.col("id.text")
    cut = F.when(F.size("spans") == 0, text).otherwise(_without(text, F.col("spans")))
    return spans.select(F.col("id.id").alias(id_col), cut.alias(text_col))


def _without(text: Column, spans: Column) -> Column:
    # Upper case counts as words here, since the text is not lower-cased: A-Z joins the class.
    gaps = F.split(text, "[0-9A-Za-z\\x{80}-\\x{10FFFF}]+")
    words = F.regexp_extract_all(text, F.lit("[0-9A-Za-z\\x{80}-\\x{10FFFF}]+"), F.lit(0))
    kept = F.transform(words, lambda w, i: F.when(
        F.exists(spans, lambda s: (s["start"] <= i) & (i < s["end"])), F.lit("")).otherwise(w))
    pairs = F.zip_with(gaps, F.concat(kept, F.array(F.lit(""))), lambda g, w: F.concat(g, w))
    return F.array_join(pairs, "")
