"""One query per operator, over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm import (
    bpe, conversation_repair, decontaminate, fingerprints, html_text, language_id, license_scan, lsh_forest, ngram_join,
    periodic_runs, pii, token_files, warc,
)

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = token_files.write(table(spark, folder, "documents"), word_bpe())
    return token_files.digests(token_files.read(files, packed=True))


@query
def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    made = bpe.encode(table(spark, folder, "documents"), word_bpe())
    return made.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@query
def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.scan(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", decontaminate.words_hit(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"))


SQL["op5_decontaminate"] = """
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w
    FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w
    FROM benchmark),
grams AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
          FROM b WHERE len(w) > 0)),
places AS (
    SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
          FROM d, (SELECT DISTINCT k FROM grams) WHERE len(w) >= k)),
hits AS (SELECT r, p.k, i, item_id FROM places p JOIN grams USING (k, g)),
covered AS (
    SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
items AS (
    SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS listed
    FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)"""


@query
def op1_html_text(spark: SparkSession, folder: str) -> DataFrame:
    made = html_text.extract(table(spark, folder, "pages"))
    return made.withColumn("n_chars", F.length("text").cast("long"))


@query
def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, folder, "documents"))


@query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = license_scan.scan(table(spark, folder, "documents"))
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    starts = F.transform("places", lambda p: p["word"])
    score = F.when(F.size("places") > 0, 1.0).otherwise(
        F.coalesce(F.array_max(F.transform("blocks", lambda m: m["share"])), F.lit(0.0)))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.transform("blocks", lambda m: m["label"]))), ",").alias("labels"),
        score.alias("score"))


@query
def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    made = fingerprints.compare_neighbours(table(spark, folder, "documents"))
    return made.select("doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), "fingerprint",
                       "edited_fingerprint", "near_edited", "near_next")


def held_out():
    """Whether a document may not be learned from, by its id alone."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)).eqNullSafe(F.lit(2))


@query
def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language_id.learn(docs.where(~held_out()))
    made = language_id.predict(docs.select("doc_id", "text"), model)
    return made.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = pii.scan(docs, pii.learn(docs))
    base = F.filter("spans", lambda s: s["base"])

    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


@query
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.write(table(spark, folder, "pages"))
    return warc.read(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op11_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, folder, "documents"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """Every tenth document, by a hash of its id, goes over from a word on into repeats of what follows there."""
    digest = F.crc32(F.col("doc_id").cast("string"))
    spread = F.floor(digest / 10)

    def repeated(words):
        n = F.size(words).cast("long")
        start = spread % n
        period = 1 + F.floor((n - start) / (3 + spread % 8))
        places = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < start, i).otherwise(start + (i - start) % period))
        return F.array_join(F.transform(places, lambda i: F.get(words, i.cast("int"))), " ")

    # The words are bound by name, so that they are found once and not for every place.
    words = F.array(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    text = F.get(F.transform(words, lambda w: F.when(F.size(w) > 0, repeated(w))), 0)
    return docs.select("doc_id", F.when(digest % 10 == 0, text).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.scan(with_repeats(table(spark, folder, "documents")))

    def first(a, b):
        more, less = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(more > less, -1).when(more < less, 1).when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
                .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))

    best = F.get(F.array_sort("runs", first), 0)
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    lines = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """Some rows, by a hash of conversation and turn, are lost, emptied, cut, repeated or given to the user."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                       (F.crc32(key) % 20).alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times")).select(
        "conv_id", "turn", "role", "text", F.explode("times").alias("time")).drop("time")


@query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    return conversation_repair.report(conversation_repair.repair(damaged(rows)), rows)


SQL["op11_lsh_forest"] = """
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
        range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' ')))) END AS g
    FROM d),
sets AS (SELECT g, row_number() OVER () AS k FROM (SELECT DISTINCT g FROM s WHERE len(g) > 0)),
grams AS (SELECT k, len(g) AS n, unnest(g) AS gram FROM sets),
near AS (
    SELECT a.k AS x, b.k AS y FROM grams a JOIN grams b USING (gram)
    WHERE a.k <> b.k AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
    SELECT k AS x, k AS y FROM sets
    UNION
    SELECT reach.x, near.y FROM reach JOIN near ON reach.y = near.x),
least_of AS (SELECT k, min(doc_id) AS least FROM s JOIN sets USING (g) GROUP BY k),
named AS (SELECT x AS k, min(least) AS component_id FROM reach JOIN least_of ON reach.y = least_of.k GROUP BY x)
SELECT doc_id, len(s.g)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM s LEFT JOIN sets USING (g) LEFT JOIN named USING (k)"""


def _repair_sql() -> str:
    def put_in(before: str, role: str) -> str:
        return f"CASE WHEN {before} IS NOT NULL THEN {{'c': {before}.c + 3, 'a': {before}.a || 'I', 't': list_append({before}.t, '{role}:')}} END"

    def deleted(before: str) -> str:
        return f"CASE WHEN {before} IS NOT NULL THEN {{'c': {before}.c + 4, 'a': {before}.a || 'D', 't': {before}.t}} END"

    def kept(before: str, initial: str) -> str:
        return (f"CASE WHEN {before} IS NOT NULL AND NOT must AND initial = '{initial}' THEN {{'c': {before}.c + extra, "
                f"'a': {before}.a || 'K', 't': list_append({before}.t, role || ':' || text)}} END")

    def given(before: str, role: str) -> str:
        return (f"CASE WHEN {before} IS NOT NULL AND NOT must THEN {{'c': {before}.c + 3 + extra, "
                f"'a': {before}.a || 'R', 't': list_append({before}.t, '{role}:' || text)}} END")

    return f"""
WITH RECURSIVE hashed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(
            string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::UBIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]),
            lambda x, k: xor(x >> 1, 3988292384::UBIGINT * (x & 1))))) % 20 AS h
    FROM conversations),
damaged AS (
    SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM (SELECT *, unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hashed)),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS k, left(role, 1) AS initial,
           regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS final
    FROM damaged),
marked AS (
    SELECT *, CASE WHEN final = '' THEN 'blank'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
                   WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY k) || initial AS two
    FROM ordered),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id),
rows_of AS (
    SELECT conv_id, k, role, text, initial, fault IN ('blank', 'duplicate') AS must,
           CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra
    FROM marked),
paths AS (
    SELECT conv_id, 0::BIGINT AS k, {{'c': 0, 'a': '', 't': []::VARCHAR[]}} AS b0, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR[]) AS b1,
           NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR[]) AS b2, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR[]) AS b3
    FROM counted
    UNION ALL
    SELECT conv_id, k, {deleted("b0")}, least({deleted("b1")}, {kept("b0", "s")}),
           least({deleted("u")}, {kept("b0", "u")}, {kept("b1", "u")}, {kept("e", "u")},
                 {given("b0", "user")}, {given("b1", "user")}, {given("e", "user")}),
           least({deleted("e")}, {kept("u", "a")}, {given("u", "assistant")})
    FROM (
        SELECT *, least(b3, {put_in("u", "assistant")}) AS e FROM (
            SELECT p.conv_id, r.k, r.role, r.text, r.initial, r.must, r.extra, b0, b1, b3,
                   least(b2, {put_in("b0", "user")}, {put_in("b1", "user")}, {put_in("b3", "user")}) AS u
            FROM paths p JOIN rows_of r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.k = p.k + 1))),
ends AS (
    SELECT conv_id, least(b0, b3, {put_in("u", "assistant")}) AS best FROM (
        SELECT p.conv_id, b0, b3, least(b2, {put_in("b0", "user")}, {put_in("b1", "user")}, {put_in("b3", "user")}) AS u
        FROM paths p JOIN counted c ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.k = c.n))
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted ON o.conv_id IS NOT DISTINCT FROM counted.conv_id LEFT JOIN ends ON o.conv_id IS NOT DISTINCT FROM ends.conv_id"""


SQL["op13_conversation_repair"] = _repair_sql()
