"""Mixing sources to target weights by iterative proportional fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import cut
from .arrow import unused

MARGINS = ("source", "lang", "topic")
ROUNDS = 10  # at least
MOST_ROUNDS = 200
TOLERANCE = 1e-3  # largest relative error of a margin that ends the rounds
MOST_CELLS = 1 << 18  # rates that are sent to every executor; more are joined by a shuffle


def topic_of(text: Column) -> Column:
    """A stand-in for a topic column: the form of the text."""
    return (
        F.when(F.instr(text, "|") > 0, "table")
        .when((F.instr(text, "***") > 0) | (F.instr(text, "###") > 0), "markup")
        .when(F.length(text) < 500, "note")
        .when(F.length(text) < 5000, "article")
        .otherwise("book")
    )


def tokens_of(text: Column) -> Column:
    """Words, as runs between blanks of any kind; a text without words counts as one, so every cell has weight."""
    return F.greatest(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(1)).cast("long")


def softened(cells: DataFrame, margin: str, power: float = 0.5) -> DataFrame:
    """Target shares that flatten a margin: tokens ** power."""
    return cells.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """Add ``weight`` to cells so that its sums over each margin have the target shares.

    ``cells`` has one row per combination with ``tokens``; a target has the
    margin's values and a ``share`` (any positive scale).  A value without a
    target, or with share null or not above 0, gets weight 0.  Each round fits
    the margins one after the other, so the last one is met exactly; sums are
    pre-aggregated and the table of cells is written after each fit.  Rounds go on
    until all margins are met to TOLERANCE; targets that exclude each other end
    at MOST_ROUNDS with the last margin met, and ``margin_error`` tells by how
    much the others are missed.
    """
    fit = cells.withColumn("weight", F.col("tokens").cast("double"))
    goals = {}
    for margin, t in targets.items():
        t = t.where("share > 0")
        total = t.agg(F.sum("share")).first()[0] or 1.0
        goals[margin] = cut(t.select(margin, (F.col("share") / F.lit(total)).alias("__goal")))
    for k in range(max(rounds, MOST_ROUNDS)):
        for margin, goal in goals.items():
            now = fit.groupBy(margin).agg(F.sum("weight").alias("__now"))
            step = now.join(goal, margin, "left").select(
                margin, F.when(F.col("__now") > 0, F.coalesce("__goal", F.lit(0.0)) / F.col("__now")).otherwise(0.0).alias("__step")
            )
            # written each time: plans that hold the cells twice per margin would grow eightfold in a round
            fit = cut(fit.join(step, margin).withColumn("weight", F.col("weight") * F.col("__step")).drop("__step"))
        if k + 1 >= rounds and margin_error(fit, goals) <= TOLERANCE:
            break
    return fit


def margin_error(fit: DataFrame, goals: dict[str, DataFrame]) -> float:
    """Largest relative difference between a margin's weights and its goals that have any weight."""
    worst = 0.0
    for margin, goal in goals.items():
        now = fit.groupBy(margin).agg(F.sum("weight").alias("__now")).join(goal, margin)
        off = now.where("__now > 0").agg(F.max(F.abs(F.col("__now") / F.col("__goal") - 1))).first()[0]
        worst = max(worst, off or 0.0)
    return worst


def uniform(id_col: Column) -> Column:
    """A number in [0, 1) that the id alone decides."""
    digest = F.md5(F.concat(F.lit("mix:"), F.coalesce(id_col.cast("string"), F.lit("none"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def _cell(text_col: str, topic: Column | None) -> list[Column]:
    """The margins of a row; null is a value of its own, ''."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    value = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in MARGINS[:2]]
    return [*value, topic_of(text) if topic is None else F.coalesce(topic.cast("string"), F.lit(""))]


def _rated(docs: DataFrame, targets: dict[str, DataFrame] | None = None, power: float = 0.5, rounds: int = ROUNDS, id_col: str = "doc_id",
           text_col: str = "text", topic: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with their cell and tokens, and the probability of every cell."""
    named = [c.alias(m) for c, m in zip(_cell(text_col, topic), MARGINS, strict=True)]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = cut(docs.select(F.col(id_col).cast("long").alias("doc_id"), *named, tokens_of(text).alias("tokens")))
    cells = cut(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")))
    fit = rake(cells, targets or {m: softened(cells, m, power) for m in MARGINS}, rounds)
    rates = fit.withColumn("__rate", F.col("weight") / F.col("tokens"))
    most = rates.agg(F.max("__rate")).first()[0] or 1.0
    return rows, rates.select(*MARGINS, F.round(F.col("__rate") / F.lit(most), 9).alias("probability"))


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, power: float = 0.5, rounds: int = ROUNDS,
          id_col: str = "doc_id", text_col: str = "text", topic: Column | None = None) -> DataFrame:
    """doc_id, source, lang, topic, tokens, probability, kept of every document.

    Token weights are raked to the margins of source, language and topic; a
    document's probability is its cell's weight per token, scaled so that the
    largest is 1.  Expected tokens of the sample then have the target shares.
    The draw is a hash of the id, so it can be repeated.  Null values of a
    margin are the value '' of their own, null text is empty, repeated rows
    share their fate, an empty table gives none.
    """
    rows, rates = _rated(docs, targets, power, rounds, id_col, text_col, topic)
    # few cells, but a cell may hold a third of the documents: adaptive execution splits or broadcasts
    return rows.join(rates, list(MARGINS)).withColumn("kept", uniform(F.col("doc_id")) < F.col("probability")).select(
        "doc_id", *MARGINS, "tokens", "probability", "kept"
    )


def drop_unsampled(docs: DataFrame, **options) -> DataFrame:
    """The sampled documents with all their columns.

    A row is decided by its own cell's rate and the hash of its id, so texts
    stay where they are: there is one rate for each cell.  Nulls, repeated rows
    and an empty table are treated as in ``mixed``; other columns may have any
    name.
    """
    rows, rates = _rated(docs, **options)
    cell, rate = unused(docs, "__cell"), unused(docs, "__rate")
    known = cut(rates.select(F.struct(*MARGINS).alias(cell), F.col("probability").alias(rate)))
    if known.count() <= MOST_CELLS:
        known = F.broadcast(known)
    id_col, text_col, topic = options.get("id_col", "doc_id"), options.get("text_col", "text"), options.get("topic")
    mine = F.struct(*[c.alias(m) for c, m in zip(_cell(text_col, topic), MARGINS, strict=True)])
    drawn = docs.withColumn(cell, mine).join(known, cell).where(uniform(F.col(id_col).cast("long")) < F.col(rate))
    return drawn.select(*docs.columns)


def oracle(power: float = 0.5, rounds: int = ROUNDS) -> str:
    """The same in SQL for a table ``documents``."""
    body = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
r AS (SELECT doc_id, source, lang,
  CASE WHEN contains(t, '|') THEN 'table' WHEN contains(t, '***') OR contains(t, '###') THEN 'markup'
       WHEN length(t) < 500 THEN 'note' WHEN length(t) < 5000 THEN 'article' ELSE 'book' END AS topic,
  greatest(len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')), 1) AS tokens FROM d),
c0 AS (SELECT source, lang, topic, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(tokens) AS DOUBLE) AS weight FROM r GROUP BY ALL)"""
    for m in MARGINS:
        body += f""",
g_{m} AS (SELECT {m}, s / sum(s) OVER () AS goal FROM (SELECT {m}, pow(CAST(sum(tokens) AS DOUBLE), {power}) AS s FROM c0 GROUP BY 1))"""
    k = 0
    for _ in range(rounds):
        for m in MARGINS:
            body += f""",
c{k + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens, weight * goal / sum(weight) OVER (PARTITION BY {m}) AS weight FROM c{k} JOIN g_{m} USING ({m}))"""
            k += 1
    return body + f""",
p AS (SELECT source, lang, topic, round(weight / tokens / max(weight / tokens) OVER (), 9) AS probability FROM c{k})
SELECT doc_id, source, lang, topic, tokens, probability,
  CAST(concat('0x', substr(md5(concat('mix:', coalesce(CAST(doc_id AS VARCHAR), 'none'))), 1, 13)) AS BIGINT) / 4503599627370496.0 < probability AS kept
FROM r JOIN p USING (source, lang, topic)"""


