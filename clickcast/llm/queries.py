"""The registered queries of this package: thin digests of what the operators return, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickcast.llm import conversations, decontaminate, langid, licenses, linededup, mixing, neardup, quality, rules, runs, secrets
from clickcast.llm import sharding, warc
from clickcast.llm.common import held_out, split_words
from clickcast.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("base_spans").cast("binary"), 256)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "n_random", digest.alias("base_sha256"), "spans")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(_table(spark, sf_dir, "documents"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, min_shared=85, of=100)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.judge(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hit_counts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.fit(spark, docs))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, folder = _table(spark, sf_dir, "pages"), scratch_path(spark, "warc")
    warc.write_archives(pages, folder)
    found = warc.read_archives(spark, folder)
    kind = pages.schema["page_id"].dataType
    return found.select(
        F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.line_counts(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def _with_repeats(docs: DataFrame) -> DataFrame:
    """The texts of a tenth of the documents, by their id's hash, made periodic from some word on."""
    hashed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words, g = split_words(F.col("text")), F.floor(hashed / 10)
    n = F.size(words)
    a = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("int")
    again = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
    periodic = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), F.flatten(again)), F.lit(1), n), " ")
    return docs.select("doc_id", F.when(hashed % 10 == 0, periodic).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(_with_repeats(_table(spark, sf_dir, "documents")))
    # Of runs with as many periods the first of the list counts: it starts first, or has the smaller period.
    more = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.aggregate("runs", none, lambda b, r: F.when(more(b, r), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def _damaged(turns: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user by the hash of conversation and turn."""
    named = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    rows = turns.withColumn("h", F.crc32(named.cast("binary")) % 20).filter("h <> 0")
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    cut = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate(text, ".!?", "")).otherwise(text)
    times = F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    changed = F.when(F.col("h") == 4, "user").otherwise(role)
    return rows.select("conv_id", "turn", changed.alias("role"), cut.alias("text"), F.explode(times).alias("copy")).drop("copy")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    repair = conversations.find_repair(_damaged(turns))
    sums = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    texts = ("audit", "repaired_sha256")
    # A row of each kind per conversation, put together by one aggregation; conversations without rows have only their id.
    kinds = (conversations.report(repair), conversations.digests(repair), turns.select(F.struct(F.col("conv_id").alias("id")).alias("conv")).distinct())
    both = kinds[0].unionByName(kinds[1], allowMissingColumns=True).unionByName(kinds[2], allowMissingColumns=True)
    whole = both.groupBy("conv").agg(*(F.max(c).alias(c) for c in (*sums, *texts)))
    return whole.select(
        F.col("conv.id").alias("conv_id"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in sums),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sharding.write_shards(_table(spark, sf_dir, "documents"), scratch_path(spark, "shards"))
    rows = sharding.read_shards(spark, made)
    none = F.lit(None).cast("int")
    return rows.select("row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", none.alias("grown_shard"))


QUERIES = {
    "op1_language": op1_language,
    "op2_secrets": op2_secrets,
    "op3_mixing": op3_mixing,
    "op4_minhash": op4_minhash,
    "op5_rules": op5_rules,
    "op6_decontaminate": op6_decontaminate,
    "op7_licenses": op7_licenses,
    "op8_warc": op8_warc,
    "op9_quality": op9_quality,
    "op10_lines": op10_lines,
    "op11_runs": op11_runs,
    "op12_conversations": op12_conversations,
    "op13_shards": op13_shards,
}
