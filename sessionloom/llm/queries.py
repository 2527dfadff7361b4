"""The registered queries of the operators, with SQL where it can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune
from . import exact, hardneg, langid, mixing, neighbours, ngrams, packing, ranked, secrets, simhash, templates, toxicity, warc
from .arrow import map_columns

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


EXACT_SQL = r"""
WITH n AS (SELECT doc_id, coalesce(length(text), 0) AS points,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
h AS (SELECT doc_id, points, sha256(norm) AS text_sha256 FROM n),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY text_sha256) AS group_size FROM h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g"""


@query("op2_exact_dedup", EXACT_SQL)
def _(spark, d):
    """Exact groups of all documents; the digest of every text comes from the operator's hash step."""
    docs = table(spark, d, "documents")
    groups = exact.exact_groups(docs).drop("copies").alias("g")
    full = exact.digests(docs).alias("f")
    return groups.join(full, F.expr("g.doc_id <=> f.doc_id")).select("g.*", "f.text_sha256")


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex FROM p),
b AS (SELECT *, array_to_string(list_transform(range(8), lambda i:
        array_to_string(list_transform(range(4), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
          ((CAST(concat('0x', substr(hex, CAST(i * 5 + 1 AS INT), 5)) AS BIGINT) >> CAST(15 - 5 * j AS BIGINT)) & 31) + 1, 1)), '')), '')
        AS payload_digest FROM h),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM b)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to FROM m"""


@query("op4_warc_bundles", WARC_SQL)
def _(spark, d):
    """All pages written as seekable bundles and read back."""
    bundles = warc.write_bundles(table(spark, d, "pages"))
    return warc.read_records(bundles).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_entropy_secrets")
def _(spark, d):
    """Secrets in all documents, as counts and digests of their spans."""
    found = secrets.find_secrets(table(spark, d, "documents"))

    def digest(ids, spans):
        rows = [[(s["start"], secrets.KINDS.index(s["kind"]), s["end"]) for s in r] for r in spans]
        base = [[s for s in r if s[1] < 3] for r in rows]
        return {
            "doc_id": ids,
            "n_assign": [sum(s[1] == 0 for s in r) for r in base],
            "n_access": [sum(s[1] == 1 for s in r) for r in base],
            "n_hex": [sum(s[1] == 2 for s in r) for r in base],
            "base_sha256": [hashlib.sha256(secrets.joined(r).encode()).hexdigest() for r in base],
            "spans": [secrets.joined(r) for r in rows],
        }

    ddl = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_columns(found, digest, ddl)


@query("op7_simhash_ball")
def _(spark, d):
    """Components of all documents at three or fewer differing bits."""
    groups = simhash.near_groups(table(spark, d, "documents"))
    shown = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return groups.select("doc_id", shown.alias("fingerprint"), "component_id")


@query("op8_cutting_stock_packing")
def _(spark, d):
    """All documents tokenized, cut and packed into sequences of 2048 tokens."""
    return packing.pack(packing.pieces(table(spark, d, "documents")))


def remainder(n: int, id_col: str = "doc_id"):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")) % n


@query("op1_byte_cnn_language")
def _(spark, d):
    """Language of every document; every fourth is held out of training."""
    docs = table(spark, d, "documents")
    model = langid.train(docs, remainder(4, "id") != 2)
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op10_elias_fano_lm")
def _(spark, d):
    """Scores of all documents under a model of six sevenths of them."""
    scored = ngrams.score(table(spark, d, "documents"), remainder(7) == 2)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op3_projected_neighbours")
def _(spark, d):
    """The 20 nearest by inner product for every twentieth vector."""
    return neighbours.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op6_raked_mixture", mixing.oracle())
def _(spark, d):
    """Sampling probabilities of all documents for flattened margins of source, language and topic."""
    return mixing.mixed(table(spark, d, "documents"))


@query("op9_ordinal_toxicity")
def _(spark, d):
    """Expected severity of all documents."""
    docs = table(spark, d, "documents")
    return toxicity.predict(docs, toxicity.train(docs, table(spark, d, "labels")))


@query("op11_template_main_text")
def _(spark, d):
    """Main text of all pages by the templates of their hosts."""
    return templates.main_text(table(spark, d, "pages"))


HARD_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
             CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""


@query("op12_bond_hard_negatives", HARD_SQL)
def _(spark, d):
    """Hard negatives of every hundredth vector, with the labels of every seventh moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


RANKED_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents WHERE doc_id IS NOT NULL),
r AS (SELECT row_number() OVER () AS r, doc_id, ts, len(ts) AS n FROM d WHERE len(ts) > 0),
a AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM r),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL),
w AS (SELECT r, term FROM (SELECT r, unnest(ts) AS term FROM r) WHERE term IN (SELECT term FROM q)),
t AS (SELECT r, term, count(*) AS tf FROM w GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM t, a GROUP BY term),
s AS (SELECT item_id, r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)))) AS BIGINT) AS score
      FROM q JOIN t USING (term) JOIN f USING (term) JOIN r USING (r), a GROUP BY ALL),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
      FROM s JOIN r USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50"""


@query("op13_rmq_ranked_search", RANKED_SQL)
def _(spark, d):
    """The 50 best documents for every benchmark item."""
    return ranked.ranked_search(table(spark, d, "documents"), table(spark, d, "benchmark"))
