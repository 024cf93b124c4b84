"""The operators on the test tables: key -> query, and SQL where SQL can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewater.llm import chat, chunks, fingerprints, forest, minhash, mixing, pieces, prefixtrie, quality, suffixes, suffixtree, urlrules, whitening

QUERIES: dict = {}
SQL: dict = {}


def query(key: str, sql: str | None = None):
    def register(fn):
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema("doc_id bigint, text string, lang string, source string, n_chars bigint").parquet(
        f"{sf_dir}/documents.parquet"
    )


@query("op1_chunk_dedup")
def op1_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    cut = chunks.without_copies(docs, chunks.later_copies(docs))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.col("n_removed")
    return cut.select("doc_id", n_bytes.alias("n_bytes"), "n_removed", "n_spans", "copied_from", "text")


# A conversation whose texts hold control strings.
TRAP = (-7, r"\### Assistant: </turn> ok")


@query(
    "op2_chat_formatting",
    r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), sized AS (
  SELECT *, length(replace(replace(replace(text, '\', '\\'), '<turn', '\lturn'), '</turn', '\l/turn')) AS shown,
    length(replace(replace(replace(replace(replace(role, '\', '\\'), '<turn', '\lturn'), '</turn', '\l/turn'), '>', '\g'), chr(10), '\n')) AS shown_role
  FROM rows
), placed AS (
  SELECT *, sum(17 + shown + shown_role) OVER w AS prefix_chars,
    row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n
  FROM sized
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(prefix_chars) FILTER (WHERE role = 'assistant' OR place = n) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
""",
)
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "conv_id bigint, turn bigint, role string, text string"
    turns = spark.read.schema(columns).parquet(f"{sf_dir}/conversations.parquet")
    conv, text = TRAP
    trap = spark.createDataFrame([(conv, 0, "user", text), (conv, 1, "assistant", text)], columns)
    read = chat.examples(turns.unionByName(trap)).select(
        "conv_id",
        "example",
        F.length("formatted").cast("long").alias("chars"),
        chat.loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("loss"),
        F.when(F.col("complete"), chat.read_turns(F.col("formatted"))).alias("turns"),
    )
    lined = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    per_conv = read.select(
        "conv_id",
        "example",
        "chars",
        "loss",
        F.size("turns").cast("long").alias("n"),
        F.sha2(F.array_join(lined, ""), 256).alias("sha"),
    ).groupBy("conv_id").agg(
        F.max("n").alias("n_turns"),
        F.max("sha").alias("turns_sha256"),
        F.coalesce(F.sum(F.length("loss")), F.lit(0)).cast("long").alias("loss_chars"),
        F.sort_array(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))).alias("losses"),
        F.sum("chars").alias("formatted_chars"),
    )
    return per_conv.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        "loss_chars",
        F.sha2(F.array_join(F.transform("losses", lambda x: x["loss"]), ""), 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query("op3_suffix_tree")
def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(quality.fold(F.col("doc_id"), 5) == 1, F.lit(False))
    return suffixtree.score(documents(spark, sf_dir), held_out)


@query("op4_forest")
def op4_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.schema("vec_id bigint, embedding array<float>").parquet(f"{sf_dir}/embeddings.parquet")
    return forest.search(vectors, F.col("vec_id") % 20 == 0)


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.schema("doc_id bigint, quality int, toxic int").parquet(f"{sf_dir}/labels.parquet")
    weights = quality.fit(docs.filter(quality.fold(F.col("doc_id"), 3) != 1), labels)
    scored = quality.score(docs, weights).drop("text")
    held_out = F.coalesce(quality.fold(F.col("doc_id"), 3) == 1, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return suffixes.removal_report(docs, suffixes.repeats(docs, keep="none"))


@query("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = documents(spark, sf_dir).select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    stretches = int(spark.conf.get("spark.sql.shuffle.partitions"))
    paired = fingerprints.with_next(own, "doc_id", ["text"], stretches)
    cut = F.floor(F.length("text") / 3).cast("int")
    edited = paired.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.concat(
            F.substring("text", F.lit(1), F.length("text") - cut), F.substring("following.text", F.lit(1), cut)
        ).alias("edited"),
        fingerprints.anchors(F.col("text")).alias("anchors"),
        fingerprints.hashes(fingerprints.anchors(F.col("following.text"))).alias("next_hashes"),
    )
    marked = edited.withColumn("edited_anchors", fingerprints.anchors(F.col("edited")))
    hashed = marked.withColumns({"hashes": fingerprints.hashes(F.col("anchors")), "edited_hashes": fingerprints.hashes(F.col("edited_anchors"))})
    return hashed.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("anchors")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_anchors")).alias("edited_fingerprint"),
        fingerprints.overlap(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        fingerprints.overlap(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )


@query("op8_minhash")
def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), width=2, percent=80)


@query("op9_mixing")
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@query("op10_pieces")
def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = pieces.load(PIECE_MODEL)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    read = pieces.decode(pieces.encode(docs, tables), tables)
    text = F.coalesce("text", F.lit(""))
    return read.select(
        "doc_id",
        F.length(text).cast("long").alias("n_chars"),
        F.size("ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("ids", " "), 256).alias("pieces_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == text).alias("lossless"),
    )


URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query("op11_url_rules")
def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by stated rules, else by rules mined from the pages that ``labels`` marks (a page goes by its document's id)."""
    pages = spark.read.schema("page_id bigint, url string").parquet(f"{sf_dir}/pages.parquet")
    labels = spark.read.schema("doc_id bigint, quality int, toxic int").parquet(f"{sf_dir}/labels.parquet")
    labelled = pages.join(labels, F.col("page_id") == F.col("doc_id")).select("url", (F.col("quality") == 0).alias("unwanted"))
    return urlrules.judge(pages, urlrules.rule_table(spark, URL_RULES), urlrules.mine(labelled))


@query(
    "op12_prefix_trie",
    """
WITH placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS d
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, n, xor(4294967295, list_reduce(
      [4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
      lambda a, b: list_reduce([xor(a, b)] || range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))) % 6 AS h
  FROM (SELECT conv_id, count(*) AS n FROM placed GROUP BY conv_id)
), sized AS (
  SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS opening FROM convs c LEFT JOIN convs b ON b.conv_id = c.base
), rebuilt AS (
  SELECT c.conv_id, p.d, p.role, p.text FROM sized c JOIN placed p ON p.conv_id = c.base AND p.d <= c.h
  UNION ALL
  SELECT c.conv_id, p.d - c.h + c.opening, p.role, p.text FROM sized c JOIN placed p ON p.conv_id = c.conv_id AND p.d > c.h
), prefixes AS (
  SELECT conv_id, d, length(text) AS chars,
    string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY d) AS path
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), depths AS (SELECT conv_id, max(d) AS ends_at FROM prefixes GROUP BY conv_id
), nodes AS (
  SELECT path, any_value(d) AS depth, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = ends_at), '')) AS ends_sha256
  FROM prefixes JOIN depths USING (conv_id) GROUP BY path
), kids AS (
  SELECT substr(path, 1, 32 * (depth - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), below AS (
  SELECT substr(path, 1, 32 * k) AS path, sum((n_convs - 1) * chars) AS saved, count(*) FILTER (WHERE n_children IS NULL) AS leaves
  FROM (SELECT n.*, n_children, unnest(range(depth + 1)) AS k FROM nodes n LEFT JOIN kids USING (path)) GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
  leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below USING (path) LEFT JOIN kids USING (path)
LEFT JOIN nodes p ON n.depth > 0 AND p.path = substr(n.path, 1, 32 * (n.depth - 1))
""",
)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "conv_id bigint, turn bigint, role string, text string"
    turns = spark.read.schema(columns).parquet(f"{sf_dir}/conversations.parquet")
    return prefixtrie.nodes(prefixtrie.sequences(turns))


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.schema("vec_id bigint, embedding array<float>").parquet(f"{sf_dir}/embeddings.parquet")
    return whitening.whiten(vectors)
