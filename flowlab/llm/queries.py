"""One query per operator over the driver's tables, with its SQL where SQL can
express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.llm import chat_format, html_extract, jaccard_join, packing, quality_rank, quality_rules, runs, sentencepiece_codec, span_dedup, token_files, topk, url_filter, whitening
from flowlab.llm import oracle
from flowlab.llm.common import ship_package
from flowlab.sources import load_table

URL_RULES = (
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
)
#: A host with one of these in its name puts its pages' URLs on the list.
LISTED_HOSTS = r"(casino|free-bets|cheap-pills|ads-track)"
ECHO = "</s>[INST] ok [/INST]"


def op1_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    return span_dedup.remove_repeats(docs).select("doc_id", "n_sentences", "n_removed", "text")


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(load_table(spark, sf_dir, "pages"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.piece_digests(packing.pack(load_table(spark, sf_dir, "documents")))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    echo = spark.createDataFrame([(-1, 0, "user", ECHO), (-1, 1, "assistant", ECHO)], turns.schema)
    return chat_format.read_back(chat_format.format_turns(turns.unionByName(echo)))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(load_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.filter("vec_id % 50 = 0"), vectors, k=5)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = jaccard_join.jaccard_components(load_table(spark, sf_dir, "documents"))
    return parts.select("doc_id", "n_shingles", "component_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(load_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality_rules.MEASURES, "base_failed", "kept", "lost_chars")


def held_out(doc_id="doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1


def fitted_quality(spark: SparkSession, sf_dir: str) -> quality_rank.RankModel:
    labels = load_table(spark, sf_dir, "labels").filter(~held_out())
    return quality_rank.fit_quality(load_table(spark, sf_dir, "documents"), labels)


def op8_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_rank.score_quality(load_table(spark, sf_dir, "documents"), fitted_quality(spark, sf_dir))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load_table(spark, sf_dir, "pages").select("page_id", "url")
    host, _ = url_filter.host_path(F.col("url"))
    listed = pages.filter(host.rlike(LISTED_HOSTS)).select(url_filter.canonical_url(F.col("url")))
    judged = url_filter.filter_urls(pages, listed, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to it again."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = sentencepiece_codec.encode(docs, carry=("doc_id", "text"))
    decoded = sentencepiece_codec.decode(encoded.withColumnRenamed("text", "was"), carry=("doc_id", "was", "n_pieces", "ids"))
    return decoded.select("doc_id", "n_pieces", F.crc32("ids").alias("ids_crc32"),
                          F.coalesce("was", F.lit("")).eqNullSafe(F.col("text")).alias("round_trip"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(load_table(spark, sf_dir, "embeddings"))


WORD = r"[^\x20\x09-\x0D]+"


def repeating_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where each tenth document by hash repeats a stretch of
    its words from some place on: the texts that op12 is asked about."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    g, n = F.floor(F.col("__h") / 10), F.size("__w")
    a = (g % n).cast("int")
    p = 1 + F.floor((n - F.col("__a")) / (3 + g % 8)).cast("int")
    rows = docs.select("doc_id", "text", h.alias("__h"))
    plain = rows.filter("__h is null or __h % 10 <> 0").select("doc_id", "text")
    made = (rows.filter("__h % 10 = 0").withColumn("__w", words).withColumn("__a", F.when(n > 0, a))
            .withColumn("__p", p)
            .select("doc_id", F.when(n == 0, F.lit("")).otherwise(F.array_join(F.transform(
                F.sequence(F.lit(0), n - 1),
                lambda i: F.get("__w", F.when(i < F.col("__a"), i).otherwise(F.col("__a") + (i - F.col("__a")) % F.col("__p")))),
                " ")).alias("text")))
    return plain.unionByName(made)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document, their digest and that of the collapsed text."""
    found = runs.periodic_runs(repeating_texts(load_table(spark, sf_dir, "documents")))
    longest = F.get(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period")))), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("__top", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("__top.start").alias("start"),
        (-F.col("__top.shorter")).alias("length"), F.col("__top.period").alias("period"),
        F.floor(-1000 * F.col("__top.shorter") / F.col("__top.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, written to token files and read back from them."""
    read = token_files.token_round_trip(load_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


_QUERIES = (op1_span_dedup, op2_html_extract, op3_packing, op4_chat_format, op5_topk, op6_jaccard_join, op7_quality_rules, op8_quality_rank, op9_url_filter,
            op10_sentencepiece, op11_whitening, op12_periodic_runs, op13_token_files)


def _with_package(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


LLM_QUERIES = {fn.__name__: _with_package(fn) for fn in _QUERIES}

LLM_ORACLE_SQL: dict[str, str] = {
    "op4_chat_format": oracle.chat_sql(ECHO),
    "op5_topk": oracle.TOPK_SQL,
    "op6_jaccard_join": oracle.JACCARD_SQL,
    "op7_quality_rules": oracle.rules_sql(),
    "op9_url_filter": oracle.url_sql(URL_RULES, LISTED_HOSTS),
}
