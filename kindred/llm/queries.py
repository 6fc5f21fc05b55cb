"""The registered queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import html_text, line_dedup, merkle, minhash, mixing, packing, secret_scan, sharding, subwords, topk, toxicity, vector_graph, whitening

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def reach_workers(spark: SparkSession) -> None:
    """Tasks that run Python import this package: from here, unless the cluster names another place."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reach_workers(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns or "*")


@query
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixed(read(spark, sf_dir, "documents", "doc_id", "text", "source").withColumn("source", F.col("source")))
    return rows.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLES["op2_mix_sources"] = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    md5(concat_ws(chr(31), 'mix-1', coalesce(doc_id::VARCHAR, ''), coalesce(source, ''), coalesce(text, ''))) AS key
  FROM documents),
places AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT a.source, (SELECT sum(source_size) FROM places)::DOUBLE AS total, a.source_size, a.weight,
    coalesce(sum(3.0 * b.source_size) FILTER (b.source_size / b.weight < a.source_size / a.weight), 0) AS below,
    sum(b.weight) FILTER (b.source_size / b.weight >= a.source_size / a.weight) AS open
  FROM places a, places b GROUP BY ALL),
level AS (SELECT max((total - below) / open) AS level FROM levels WHERE (total - below) / open * weight <= 3.0 * source_size),
targets AS (SELECT source, source_size, least(3.0 * source_size, level * weight) AS target FROM places, level),
units AS (
  SELECT s.key, s.source, s.size, t.source_size, t.target, sum(s.size) AS mass FROM sized s
  JOIN targets t ON s.source IS NOT DISTINCT FROM t.source GROUP BY ALL),
sent AS (SELECT *, sum(mass) OVER (PARTITION BY source ORDER BY key) AS sent FROM units),
stream AS (
  SELECT key, source, mass, copy, (copy * source_size + sent)::DOUBLE / target AS finish
  FROM sent, range(3) r(copy) WHERE mass > 0),
spent AS (
  SELECT key, source, sum(mass) OVER (ORDER BY finish, source NULLS LAST, key, copy ROWS UNBOUNDED PRECEDING) AS spent FROM stream),
copies AS (
  SELECT key, source, count(*) AS copies FROM spent WHERE spent <= (SELECT sum(size) FROM sized) GROUP BY ALL)
SELECT s.doc_id, s.size, t.source_size, t.target, (s.size * coalesce(c.copies, 0))::BIGINT AS taken
FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
LEFT JOIN copies c ON c.key = s.key AND c.source IS NOT DISTINCT FROM s.source
"""


@query
def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text", "n_chars", "lang", "source")
    return sharding.with_slots(sharding.kd_shards(documents, leaves=8)).select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op6_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents", "doc_id", "text"))
    n_base = len(secret_scan.BASE_RULES)
    base = F.filter("spans", lambda s: s["rank"] < n_base)
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [of_kind(r.kind) for r in secret_scan.BASE_RULES]
    return found.select(
        "row.doc_id", *counts, F.sha2(secret_scan.joined_spans(base), 256).alias("base_sha256"),
        secret_scan.joined_spans(F.col("spans")).alias("spans"),
    )


@query
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


ORACLES["op7_near_duplicates"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) < 5 THEN [hash(w)]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: hash(w[i:i + 4]))) END AS s FROM words),
items AS (SELECT doc_id, unnest(s) AS item FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM items a JOIN items b ON a.item = b.item AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * n >= 75 * (len(x.s) + len(y.s) - n)),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM ends UNION SELECT r.a, e.b FROM reach r JOIN ends e ON r.b = e.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS component_id,
  s.doc_id = least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS kept
FROM sets s LEFT JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.s
"""


@query
def op8_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read(spark, sf_dir, "documents", "doc_id", "text")).select("row.doc_id", "text", "n_lines", "n_removed")


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(documents, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    # Only ids and scores leave the tasks.
    scored = toxicity.score(documents, model).select("row.doc_id", "score")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))


@query
def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.top_k(rows.where("vec_id % 20 = 0"), rows, 20)


ORACLES["op3_top_k"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id AS vec_id, list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole q JOIN whole r ON q.vec_id <> r.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 20
"""


@query
def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_duplicates(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query
def op11_encode_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = subwords.encode(read(spark, sf_dir, "documents", "doc_id", "text"), decoded=True)
    listed = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return coded.select(
        "row.doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents", *merkle.FIELDS), merkle.tampered_text())


def _merkle_sql(source_levels: int = 7, root_levels: int = 3) -> str:
    """Level by level: the nodes of level l are in ``t<l>`` (per source) and ``r<l>`` (the subroots), each document's way in ``w<l>`` and ``x<l>``."""
    h = "lower(sha256({}))".format
    field = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: h(" || ".join(map(field, ["doc_id", "source", "lang", "n_chars", text])))
    # crc32 by its polynomial, a bit at a time; the digits of an id are its bytes.
    shift = "lambda r, b: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END"
    byte = f"lambda r, c: list_reduce([xor(r, c)] || range(8), {shift})"
    crc = f"xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), {byte}), 4294967295)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        f"""docs AS (SELECT doc_id, source, {leaf("text")} AS leaf,
             {leaf(f"CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {lower} ELSE text END")} AS changed FROM documents)""",
        """w0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS doc, doc AS pos,
             changed AS v, '' AS proof FROM docs)""",
        "t0 AS (SELECT source AS tree, pos, leaf AS d FROM w0)",
    ]

    def level(nodes: str, ways: str, up: int, tree: str) -> None:
        before, now = f"{nodes}{up}", f"{nodes}{up + 1}"
        steps.append(f"n{before} AS (SELECT tree, count(*) AS n FROM {before} GROUP BY tree)")
        # A tree of one node stays as it is.
        steps.append(f"""{now} AS (SELECT tree, p AS pos, CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE {h("string_agg(d, '' ORDER BY pos)")} END AS d
          FROM (SELECT b.*, n, pos // 16 AS p FROM {before} b JOIN n{before} m ON b.tree IS NOT DISTINCT FROM m.tree) GROUP BY tree, p)""")
        joined = h("coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (b.pos < w.pos), '') || w.v || coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (b.pos > w.pos), '')")
        steps.append(f"""{ways}{up + 1} AS (SELECT w.doc_id, w.source, w.leaf, w.doc, w.pos // 16 AS pos,
          CASE WHEN any_value(n) = 1 THEN w.v ELSE {joined} END AS v, w.proof || coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (b.pos <> w.pos), '') AS proof
          FROM {ways}{up} w JOIN {before} b ON b.tree IS NOT DISTINCT FROM {tree} AND b.pos // 16 = w.pos // 16
          JOIN n{before} m ON m.tree IS NOT DISTINCT FROM {tree} GROUP BY w.doc_id, w.source, w.leaf, w.doc, w.pos, w.v, w.proof)""")

    for up in range(source_levels):
        level("t", "w", up, "w.source")
    last = f"t{source_levels}"
    steps.append(f"places AS (SELECT tree AS source, d, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place FROM {last})")
    steps.append("r0 AS (SELECT 0 AS tree, place AS pos, d FROM places)")
    steps.append(f"""x0 AS (SELECT w.doc_id, w.source, w.leaf, w.doc, place AS pos, w.v, w.proof
      FROM w{source_levels} w JOIN places p ON p.source IS NOT DISTINCT FROM w.source)""")
    for up in range(root_levels):
        level("r", "x", up, "0")
    return f"""WITH {", ".join(steps)}
SELECT x.doc_id, x.leaf, p.d AS subroot, r.d AS root, {h("x.proof")} AS proof_sha256, x.v AS folded_root, x.v = r.d AS verified
FROM x{root_levels} x JOIN places p ON p.source IS NOT DISTINCT FROM x.source, r{root_levels} r"""


ORACLES["op12_merkle_manifest"] = _merkle_sql()


@query
def op13_whiten_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.components(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    # At some 100 million vectors the deviation exceeds a long; it is null there, and whole in the operator's own result.
    return found.withColumn("deviation", F.col("deviation").try_cast("long")).select("row.vec_id", *[c for c in found.columns if c != "row"])
