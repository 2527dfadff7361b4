"""The data model of the operators, derived from the given tables.

Each input exists twice, as a DataFrame and as SQL for the check; both read
whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordered import over_slices

HOUR = 3_600_000
DAY = 24 * HOUR
MS = "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


INPUT_SQL: dict[str, str] = {}

# Raw event log: session, kind, clock, JSON payload.
INPUT_SQL["px_events"] = """
SELECT user_id AS session_id, event_id, event_type AS kind, epoch_us(ts)//1000 AS client_ms,
       json_extract_string(props,'$.k') AS k, props, value FROM events"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "user_id AS session_id",
        "event_id",
        "event_type AS kind",
        f"{MS.format('ts')} AS client_ms",
        "get_json_object(props, '$.k') AS k",
        "props",
        "value",
    )


# The event log with structured JSON payloads, built from the k value of each event.
INPUT_SQL["px_log"] = """
SELECT session_id, event_id, kind, client_ms, k,
 concat('{"task_id":"', CASE WHEN n%10=0 THEN '' ELSE concat('task_', n%10) END, '","task_type":"', CASE WHEN n%2=0 THEN 'eye' ELSE 'breath' END,
  '","element_id":"', k, '","input_modality":"voice","config":{"count":', n%7, ',"input_modality":"', CASE WHEN n%2=0 THEN 'voice' ELSE '' END,
  '"},"element_content":{"element_type":"t', n%3, '","response_time_seconds":', n%3, ',"task_metadata":{"task_id":"', CASE WHEN n%10=0 THEN '' ELSE concat('task_', n%10) END,
  '","current_count":', n%4, ',"config":{"response_time_seconds":', n%5, '}}}}') AS payload
FROM (SELECT *, CAST(k AS INT) AS n FROM px_events)"""


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    task = "CASE WHEN n % 10 = 0 THEN '' ELSE concat('task_', n % 10) END"
    return (
        events(spark, sf_dir)
        .withColumn("n", F.col("k").cast("int"))
        .selectExpr(
            "session_id",
            "event_id",
            "kind",
            "client_ms",
            "k",
            f"""concat('{{"task_id":"', {task}, '","task_type":"', CASE WHEN n % 2 = 0 THEN 'eye' ELSE 'breath' END,
            '","element_id":"', k, '","input_modality":"voice","config":{{"count":', n % 7, ',"input_modality":"',
            CASE WHEN n % 2 = 0 THEN 'voice' ELSE '' END, '"}},"element_content":{{"element_type":"t', n % 3,
            '","response_time_seconds":', n % 3, ',"task_metadata":{{"task_id":"', {task}, '","current_count":', n % 4,
            ',"config":{{"response_time_seconds":', n % 5, '}}}}}}}}') AS payload""",
        )
    )


# Elements: view/purchase events paired by (session, k), the last row of each wins.
INPUT_SQL["px_elements"] = """
SELECT s.session_id, concat(CASE WHEN CAST(s.k AS INT)%3=0 THEN 'open_' WHEN CAST(s.k AS INT)%3=1 THEN 'close_' ELSE 'intro_' END, s.k) AS element_id,
       CASE WHEN CAST(s.k AS INT)%2=0 THEN 'eye' ELSE 'breath' END AS task_type, o AS ordinal, st AS start_ms, en AS end_ms
FROM (SELECT session_id, k, arg_max(client_ms,event_id) st, min(event_id) o FROM px_events WHERE kind='view' GROUP BY 1,2) s
JOIN (SELECT session_id, k, arg_max(client_ms,event_id) en FROM px_events WHERE kind='purchase' GROUP BY 1,2) e
  ON s.session_id=e.session_id AND s.k=e.k WHERE en>=st"""


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.events import pair_by_key

    ev = events(spark, sf_dir)
    pairs = pair_by_key(
        ev.where("kind = 'view'"), ev.where("kind = 'purchase'"), ["session_id", "k"], "event_id", ["client_ms"]
    )
    return pairs.where("end_client_ms >= start_client_ms").selectExpr(
        "session_id",
        "concat(CASE int(k) % 3 WHEN 0 THEN 'open_' WHEN 1 THEN 'close_' ELSE 'intro_' END, k) AS element_id",
        "CASE WHEN int(k) % 2 = 0 THEN 'eye' ELSE 'breath' END AS task_type",
        "ordinal",
        "start_client_ms AS start_ms",
        "end_client_ms AS end_ms",
    )


# Two device streams: click = EEG frames, error = optical frames, ideal period one hour.
INPUT_SQL["px_frames"] = """
SELECT session_id, CASE kind WHEN 'click' THEN 'eeg' ELSE 'fnirs' END AS stream,
       row_number() OVER (PARTITION BY session_id,kind ORDER BY client_ms,event_id)-1 AS frame,
       client_ms AS ts_ms, value FROM px_events WHERE kind IN ('click','error')"""


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).where("kind IN ('click', 'error')")
    ranked = over_slices(ev, ["session_id", "kind"], ["client_ms", "event_id"], 30 * DAY, rank="rn")
    return ranked.selectExpr(
        "session_id",
        "CASE kind WHEN 'click' THEN 'eeg' ELSE 'fnirs' END AS stream",
        "rn - 1 AS frame",
        "client_ms AS ts_ms",
        "value",
    )


# Windows: one per session and hour that has an event.
INPUT_SQL["px_windows"] = """
SELECT session_id, (client_ms//3600000)*3600000 AS time_ms, avg(value) AS value, count(*) AS n FROM px_events GROUP BY 1,2"""


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events(spark, sf_dir)
        .selectExpr("session_id", "(client_ms div 3600000) * 3600000 AS time_ms", "value")
        .groupBy("session_id", "time_ms")
        .agg(F.avg("value").alias("value"), F.count(F.lit(1)).alias("n"))
    )


# Signal samples at 64 Hz: vector = channel, position = sample.
INPUT_SQL["px_samples"] = """
SELECT vec_id AS channel, vec_id%10 AS session_id, label, pos-1 AS sample, CAST(x AS DOUBLE) AS x
FROM (SELECT vec_id, label, unnest(embedding) AS x, unnest(range(1, len(embedding)+1)) AS pos FROM embeddings)"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "embeddings")
        .select("vec_id", "label", F.posexplode("embedding"))
        .selectExpr(
            "vec_id AS channel", "vec_id % 10 AS session_id", "label", "bigint(pos) AS sample", "double(col) AS x"
        )
    )


# A recording: 16 channels per session, vectors as consecutive stretches of the signal.
INPUT_SQL["px_signal"] = """
SELECT (channel//16)%4 AS session_id, channel%16 AS channel, label, ((channel//16)//4)*64+sample AS sample, x FROM px_samples"""


def signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples(spark, sf_dir).selectExpr(
        "(channel div 16) % 4 AS session_id",
        "channel % 16 AS channel",
        "label",
        "((channel div 16) div 4) * 64 + sample AS sample",
        "x",
    )


# Audio chunks of 64 samples: four sessions with their own chunk spacing.
INPUT_SQL["px_audio"] = """
SELECT vec_id%4 AS session_id, vec_id//4 AS chunk, (vec_id//4)*CASE vec_id%4 WHEN 0 THEN 8 WHEN 1 THEN 4 WHEN 2 THEN 3 ELSE 1 END AS ts_ms, embedding AS samples FROM embeddings"""


def audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id % 4 AS session_id",
        "vec_id div 4 AS chunk",
        "(vec_id div 4) * CASE vec_id % 4 WHEN 0 THEN 8 WHEN 1 THEN 4 WHEN 2 THEN 3 ELSE 1 END AS ts_ms",
        "embedding AS samples",
    )


# Session sizes: bytes from the summed event values.
INPUT_SQL["px_sessions"] = """
SELECT session_id, arg_min(client_ms,event_id) AS first_ms, arg_max(client_ms,event_id) AS last_ms, max(client_ms)-min(client_ms) AS file_ms,
  CAST(floor(round(sum(value),2)*50000000) AS BIGINT) AS size_bytes FROM px_events GROUP BY 1"""


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.curate import clean_duration

    ev = events(spark, sf_dir)
    sizes = ev.groupBy("session_id").agg(
        (F.max("client_ms") - F.min("client_ms")).alias("file_ms"),
        F.floor(F.round(F.sum("value"), 2) * 50000000).cast("long").alias("size_bytes"),
    )
    return clean_duration(ev, "event_id").join(sizes, "session_id")


# Character stream: every character of every document, 50 ms apart.
INPUT_SQL["px_chars"] = """
SELECT session_id, idx, ch, session_id*1000000+idx*50 AS ts_ms FROM (
  SELECT doc_id AS session_id, unnest(string_split(text,'')) AS ch, unnest(range(0, length(text))) AS idx FROM documents)"""


def chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A row becomes one row per character: spread the compact texts first.
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", "text")
        .repartition("doc_id")
        .select("doc_id", F.posexplode(F.split("text", "")))
        .selectExpr("doc_id AS session_id", "bigint(pos) AS idx", "col AS ch", "doc_id * 1000000 + pos * 50 AS ts_ms")
    )


# File manifest: orders as files of a customer's session.
INPUT_SQL["px_manifest"] = """
SELECT sid AS session_id, file_id, 'curated/' || sid || CASE WHEN file_id % 4 = 0 THEN '.h5' ELSE '/' || sid || '_' || CAST(ts_ms+1000000000000 AS VARCHAR) || '.h5' END AS path,
       size_bytes, ts_ms FROM (
  SELECT 'rec_' || CAST(20240101 + o_custkey % 28 AS VARCHAR) || '_' || lpad(CAST(o_custkey % 1000000 AS VARCHAR), 6, '0') AS sid, o_orderkey AS file_id,
         CAST(floor(o_totalprice*1024) AS BIGINT) AS size_bytes, epoch_us(o_orderdate)//1000 AS ts_ms FROM orders)"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .selectExpr(
            "concat('rec_', string(20240101 + o_custkey % 28), '_', lpad(string(o_custkey % 1000000), 6, '0')) AS session_id",
            "o_orderkey AS file_id",
            "bigint(floor(o_totalprice * 1024)) AS size_bytes",
            f"{MS.format('o_orderdate')} AS ts_ms",
        )
        .selectExpr(
            "session_id",
            "file_id",
            "concat('curated/', session_id, CASE WHEN file_id % 4 = 0 THEN '.h5' "
            "ELSE concat('/', session_id, '_', string(ts_ms + 1000000000000), '.h5') END) AS path",
            "size_bytes",
            "ts_ms",
        )
    )


# Processing ledger: customer x priority, status from the order status.
INPUT_SQL["px_ledger"] = """
SELECT o_custkey AS data_id, o_orderpriority AS transform_id,
       CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'skipped' ELSE 'failed' END AS status,
       epoch_us(o_orderdate)//1000 AS ts_ms, o_orderkey AS seq FROM orders"""


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS data_id",
        "o_orderpriority AS transform_id",
        "CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'skipped' ELSE 'failed' END AS status",
        f"{MS.format('o_orderdate')} AS ts_ms",
        "o_orderkey AS seq",
    )


# Language units with an element and a mode: conversation turns.
INPUT_SQL["px_units"] = """
SELECT conv_id AS element_id, turn AS idx, CASE role WHEN 'user' THEN 'R' WHEN 'assistant' THEN 'LR' END AS mode, text AS word,
       conv_id*100000+turn*1000 AS start_ms, conv_id*100000+turn*1000+900 AS end_ms FROM conversations"""


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id AS element_id",
        "turn AS idx",
        "CASE role WHEN 'user' THEN 'R' WHEN 'assistant' THEN 'LR' END AS mode",
        "text AS word",
        "conv_id * 100000 + turn * 1000 AS start_ms",
        "conv_id * 100000 + turn * 1000 + 900 AS end_ms",
    )


# Words of the turns, one row per blank-separated word, 300 ms apart.
INPUT_SQL["px_words"] = """
SELECT element_id AS session_id, idx AS turn, mode, row_number() OVER (PARTITION BY element_id ORDER BY idx, pos)-1 AS idx, word,
       start_ms + pos*300 AS start_ms, start_ms + pos*300 + 250 AS end_ms
FROM (SELECT element_id, idx, mode, start_ms, unnest(ws) AS word, unnest(range(0, len(ws))) AS pos
      FROM (SELECT *, [x for x in regexp_split_to_array(word, '[ \\n\\t\\r]+') if x <> ''] AS ws FROM px_units))"""


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    parted = units(spark, sf_dir).selectExpr(
        "element_id AS session_id",
        "idx AS turn",
        "mode",
        "start_ms AS s",
        "posexplode(filter(split(word, '[ \\\\n\\\\t\\\\r]+'), x -> x <> '')) AS (pos, word)",
    )
    ranked = over_slices(parted, ["session_id"], ["turn", "pos"], 8, rank="rn")
    return ranked.selectExpr(
        "session_id", "turn", "mode", "rn - 1 AS idx", "word", "s + pos * 300 AS start_ms", "s + pos * 300 + 250 AS end_ms"
    )


# Tokens on the same clock as elements and windows: signup events.
INPUT_SQL["px_timed_tokens"] = """
SELECT session_id, event_id AS idx, k AS token, client_ms AS start_ms, client_ms + CAST(floor(value) AS BIGINT)*1000 AS end_ms
FROM px_events WHERE kind='signup'"""


def timed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events(spark, sf_dir)
        .where("kind = 'signup'")
        .selectExpr(
            "session_id",
            "event_id AS idx",
            "k AS token",
            "client_ms AS start_ms",
            "client_ms + bigint(floor(value)) * 1000 AS end_ms",
        )
    )


# Predictions: truth = quality, prediction = 1 for documents of 600+ characters.
INPUT_SQL["px_predictions"] = """
SELECT doc_id, quality AS y, CASE WHEN n_chars>=600 THEN 1 ELSE 0 END AS p FROM labels JOIN documents USING (doc_id)"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return (
        table(spark, sf_dir, "labels")
        .join(docs, "doc_id")
        .selectExpr("doc_id", "quality AS y", "CASE WHEN n_chars >= 600 THEN 1 ELSE 0 END AS p")
    )


# Optical cells: one value of a channel in a frame; -inf marks unused channels.
INPUT_SQL["px_cells"] = """
SELECT l_suppkey AS file_id, l_orderkey AS frame, (l_linenumber % 6)*41472 + (l_partkey*97) % 41472 AS channel,
  CASE WHEN l_partkey % 11 = 0 OR (l_partkey % 3 > 0 AND l_returnflag = 'R') THEN CAST('-inf' AS DOUBLE)
       WHEN l_linenumber = 7 AND l_partkey % 3 = 1 THEN CAST('nan' AS DOUBLE)
       WHEN l_discount = 0 THEN 0.0::DOUBLE
       WHEN l_partkey % 5 = 0 AND l_linenumber = 6 THEN CAST('inf' AS DOUBLE)
       ELSE (l_extendedprice - 20000) / 1000 END AS value FROM lineitem"""


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS file_id",
        "l_orderkey AS frame",
        "(l_linenumber % 6) * 41472 + (l_partkey * 97) % 41472 AS channel",
        "CASE WHEN l_partkey % 11 = 0 OR (l_partkey % 3 > 0 AND l_returnflag = 'R') THEN double('-Infinity') "
        "WHEN l_linenumber = 7 AND l_partkey % 3 = 1 THEN double('NaN') WHEN l_discount = 0 THEN 0.0D "
        "WHEN l_partkey % 5 = 0 AND l_linenumber = 6 THEN double('Infinity') "
        "ELSE (l_extendedprice - 20000) / 1000 END AS value",
    )


# The optical channel dimension, by rule.
INPUT_SQL["px_channels"] = """
SELECT id AS channel, CAST(id%6+1 AS INT) AS det_id, CAST((id//6)%48+1 AS INT) AS det_mod, CAST((id//288)%3+1 AS INT) AS src_id,
  CAST((id//864)%48+1 AS INT) AS src_mod, CAST((id//41472)%3 AS INT) AS moment, CAST((id//124416)%2 AS INT) AS wave
FROM (SELECT unnest(range(0, 248832)) AS id)"""

# Sensor positions: every vector is a sensor, xyz from its first three values.
INPUT_SQL["px_sensors"] = """
SELECT vec_id AS sensor, CAST(vec_id%48+1 AS INT) AS mod, CAST((vec_id//48)%9+1 AS INT) AS pos,
  CAST(embedding[1] AS DOUBLE)*100 AS x, CAST(embedding[2] AS DOUBLE)*100 AS y, CAST(embedding[3] AS DOUBLE)*100 AS z FROM embeddings"""


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id AS sensor",
        "int(vec_id % 48 + 1) AS mod",
        "int((vec_id div 48) % 9 + 1) AS pos",
        "double(embedding[0]) * 100 AS x",
        "double(embedding[1]) * 100 AS y",
        "double(embedding[2]) * 100 AS z",
    )


# Layout: mean sensor position per (module, position); at most 48 x 9 rows whatever the data.
INPUT_SQL["px_layout"] = """
SELECT mod, pos, CASE WHEN pos<=3 THEN 'source' ELSE 'detector' END AS kind, CASE WHEN pos<=3 THEN pos ELSE pos-3 END AS part,
  round(avg(x),6) AS x, round(avg(y),6) AS y, round(avg(z),6) AS z FROM px_sensors GROUP BY mod, pos"""


def layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        sensors(spark, sf_dir)
        .groupBy("mod", "pos")
        .agg(*[F.round(F.avg(c), 6).alias(c) for c in "xyz"])
        .selectExpr(
            "mod",
            "pos",
            "CASE WHEN pos <= 3 THEN 'source' ELSE 'detector' END AS kind",
            "CASE WHEN pos <= 3 THEN pos ELSE pos - 3 END AS part",
            "x",
            "y",
            "z",
        )
    )


# Measurement list: one row per measured channel of a file.
INPUT_SQL["px_measurements"] = """
SELECT l_suppkey AS file_id, l_linenumber AS data_type, (l_linenumber % 6)*41472 + (l_partkey*97) % 41472 AS channel FROM lineitem"""


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS file_id", "l_linenumber AS data_type", "(l_linenumber % 6) * 41472 + (l_partkey * 97) % 41472 AS channel"
    )
