"""Language queries: every character of every document, every conversation turn."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from ..functions.ordered import over_slices
from ..operators import crossquery, editscript
from ..operators import lang as op
from . import inputs as px
from . import registry
from .registry import rounded

query = partial(registry.query, small_rows=True)  # characters, tokens, and strips of one piece or cell of them
PIECE = 200_000  # 4,000 characters at 50 ms each

TOK = """tk0 AS (SELECT *, regexp_matches(ch,'^[\\p{L}\\p{N}_'']$') AS wd, ch IN (' ',chr(10),chr(9),chr(13)) AS sp FROM px_chars),
 tk1 AS (SELECT *, NOT sp AND (NOT wd OR NOT coalesce(lag(wd) OVER (PARTITION BY session_id ORDER BY idx),false)) AS st FROM tk0),
 tk2 AS (SELECT *, sum(CAST(st AS INT)) OVER (PARTITION BY session_id ORDER BY idx) AS tok FROM tk1),
 toks AS MATERIALIZED (SELECT session_id, CAST(tok-1 AS BIGINT) AS token_idx, string_agg(ch,'' ORDER BY idx) AS token, min(idx) AS "start", max(idx)+1 AS "end", min(ts_ms) AS start_ms, max(ts_ms) AS end_ms FROM tk2 WHERE NOT sp GROUP BY 1,2)"""


def tokens(spark, d):
    return op.tokenize(px.chars(spark, d), PIECE)


@query("h1_text_pieces", f"SELECT session_id, ts_ms//{PIECE} AS piece, string_agg(ch,'' ORDER BY idx) AS text, count(*) AS n_chars FROM px_chars GROUP BY 1,2")
def _(spark, d):
    return op.text_pieces(px.chars(spark, d), PIECE).drop("times")


@query("h2_tokens", f"WITH {TOK} SELECT session_id, token_idx, token, \"start\", \"end\" FROM toks")
def _(spark, d):
    return tokens(spark, d).select("session_id", "token_idx", "token", "start", "end")


@query(
    "h2_token_ids",
    f"""WITH {TOK}, v AS (SELECT token, count(*) AS n, row_number() OVER (ORDER BY substr(md5(token||'-0'),1,15), token)-1 AS token_id FROM toks GROUP BY 1)
 SELECT session_id, count(*) AS n_tokens, CAST(sum(token_id) AS BIGINT) AS id_sum, max(token_id) AS max_id FROM toks JOIN v USING (token) GROUP BY 1""",
)
def _(spark, d):
    t = tokens(spark, d).select("session_id", "token")  # read from its packed pieces twice: less disk than a written table
    ids = op.with_ids(t, op.vocabulary(t))
    return ids.groupBy("session_id").agg(F.count(F.lit(1)).alias("n_tokens"), F.sum("token_id").alias("id_sum"), F.max("token_id").alias("max_id"))


@query("h3_token_times", f"WITH {TOK} SELECT session_id, token_idx, token, CAST(start_ms AS BIGINT) AS start_ms, CAST(end_ms AS BIGINT) AS end_ms FROM toks")
def _(spark, d):
    t = tokens(spark, d).select("session_id", "token_idx", "token", "start", "end")
    return op.align_chars(t, px.chars(spark, d)).selectExpr("session_id", "token_idx", "token", "bigint(start_ms) AS start_ms", "bigint(end_ms) AS end_ms")


@query(
    "h4_typed_token_keys",
    f"""WITH {TOK} SELECT session_id, CAST(tok-1 AS BIGINT) AS token_idx, '['||string_agg(CAST(idx AS VARCHAR),',' ORDER BY idx)||']' AS char_indices, '['||string_agg('"k'||idx%7||'"',',' ORDER BY idx)||']' AS keystroke_events,
   '['||coalesce(string_agg(CASE WHEN idx%3=0 THEN '"t'||idx%3||'"' END,',' ORDER BY idx),'')||']' AS trigger_keystrokes FROM tk2 WHERE NOT sp GROUP BY 1,2""",
)
def _(spark, d):
    c = px.chars(spark, d).withColumn("keystrokes", F.expr("array(concat('k', idx % 7))")).withColumn(
        "trigger_keystroke", F.expr("CASE WHEN idx % 3 = 0 THEN concat('t', idx % 3) END")
    )
    t = tokens(spark, d).select("session_id", "token_idx", "token", "start", "end")
    out = op.align_keys(t, c).withColumn("char_indices", F.to_json("char_indices"))
    return out.select("session_id", "token_idx", "char_indices", "keystroke_events", "trigger_keystrokes")


PLACED = "placed AS (SELECT *, CAST(sum(length(word)+1) OVER w AS BIGINT)-length(word)-1 AS text_start, CAST(sum(length(word)+1) OVER w AS BIGINT)-1 AS text_end FROM px_words WINDOW w AS (PARTITION BY session_id ORDER BY idx))"
WTOK = f"""{PLACED}, wp AS (SELECT *, regexp_extract_all(word,'[\\p{{L}}\\p{{N}}_'']+|[^\\p{{L}}\\p{{N}}_'']') AS p FROM placed),
 wt AS (SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY idx, i)-1 AS token_idx, token, text_start+lo AS "start", text_start+lo+length(token) AS "end"
   FROM (SELECT session_id, idx, text_start, i, p[i] AS token, CAST(coalesce(list_sum([length(x) for x in p[1:i-1]]),0) AS BIGINT) AS lo FROM (SELECT *, unnest(range(1,len(p)+1)) AS i FROM wp)))"""


@query("h5_word_offsets", f"WITH {PLACED} SELECT session_id, idx, word, text_start, text_end FROM placed")
def _(spark, d):
    return op.word_offsets(px.words(spark, d)).select("session_id", "idx", "word", "text_start", "text_end")


@query("h5_word_text", "SELECT session_id, idx//1000 AS piece, string_agg(word,' ' ORDER BY idx) AS text, count(*) AS n_words FROM px_words GROUP BY 1,2")
def _(spark, d):
    return op.word_text(px.words(spark, d))


def _overlap(name, cond, strict):
    @query(
        name,
        f"""WITH {WTOK} SELECT t.session_id, t.token_idx, t.token, t."start", t."end", coalesce(arg_min(w.start_ms,w.idx),0) AS start_ms, coalesce(arg_max(w.end_ms,w.idx),0) AS end_ms
 FROM wt t LEFT JOIN placed w ON w.session_id=t.session_id AND {cond} GROUP BY 1,2,3,4,5""",
    )
    def _(spark, d):
        placed = op.cut(op.word_offsets(px.words(spark, d)))
        return op.align_words(op.word_tokens(placed), placed, strict=strict)


_overlap("h6_token_word_times", 'w.text_start<=t."end" AND w.text_end>=t."start"', False)
_overlap("h6_token_word_times_strict", 'w.text_start<t."end" AND w.text_end>t."start"', True)


# Known words occur at least eight times.
KNOWN = f"{TOK}, lw AS (SELECT lower(token) AS word, count(*) AS n FROM toks WHERE regexp_matches(token,'^[\\p{{L}}\\p{{N}}_'']+$') GROUP BY 1), known AS MATERIALIZED (SELECT * FROM lw WHERE n>=8)"
FIX = f"""{KNOWN}, ws AS MATERIALIZED (SELECT DISTINCT token, lower(token) AS word FROM toks WHERE regexp_matches(token,'^[\\p{{L}}\\p{{N}}_'']+$') AND regexp_matches(token,'\\p{{L}}') AND length(token)>1 AND NOT (token=upper(token) AND token<>lower(token))),
 ow AS MATERIALIZED (SELECT DISTINCT word FROM ws ANTI JOIN known USING (word)),
 km AS MATERIALIZED (SELECT word, n, substring(word,1,i-1)||chr(1)||substring(word,i+1) AS m, substring(word,1,i-1)||substring(word,i+1) AS s FROM (SELECT *, unnest(range(1,length(word)+1)) AS i FROM known)),
 om AS MATERIALIZED (SELECT word, substring(word,1,i-1)||chr(1)||substring(word,i+1) AS m, substring(word,1,i-1)||substring(word,i+1) AS s FROM (SELECT *, unnest(range(1,length(word)+1)) AS i FROM ow)),
 cand AS MATERIALIZED (SELECT om.word, km.word AS c, km.n FROM om JOIN km ON om.m=km.m UNION SELECT ow.word, km.word, km.n FROM ow JOIN km ON ow.word=km.s UNION SELECT om.word, known.word, known.n FROM om JOIN known ON om.s=known.word),
 best AS (SELECT word, arg_min(c,(-n,c)) AS c FROM cand GROUP BY 1),
 fix AS (SELECT token, CASE WHEN substring(token,1,1)<>lower(substring(token,1,1)) THEN upper(substring(c,1,1))||substring(c,2) ELSE c END AS corrected FROM ws JOIN best USING (word))"""
ALIGNED = f"""{FIX}, co AS (SELECT t.*, coalesce(f.corrected,t.token) AS corrected, CASE WHEN coalesce(f.corrected,t.token)<>t.token THEN 1 ELSE 0 END AS ch FROM toks t LEFT JOIN fix f USING (token)),
 rn AS (SELECT *, token_idx-sum(ch) OVER (PARTITION BY session_id ORDER BY token_idx) AS run FROM co),
 al AS (SELECT session_id, token_idx, token, corrected, ch=0 AS unchanged, CASE WHEN ch=0 THEN start_ms ELSE min(start_ms) OVER r END AS start_ms, CASE WHEN ch=0 THEN end_ms ELSE max(end_ms) OVER r END AS end_ms,
   CASE WHEN ch=0 THEN token_idx ELSE min(token_idx) OVER r END AS first_original, CASE WHEN ch=0 THEN token_idx ELSE max(token_idx) OVER r END AS last_original FROM rn WINDOW r AS (PARTITION BY session_id, run, ch))"""


def counted(t):
    """Different tokens with their count, written: known words and corrections need no more of all tokens."""
    return op.cut(t.groupBy("token").agg(F.count(F.lit(1)).alias("n")))


def known(t):
    each = t if "n" in t.columns else counted(t)
    words = each.where(F.col("token").rlike(f"^{op.WORD_CLASS}+$"))
    return words.groupBy(F.lower("token").alias("word")).agg(F.sum("n").alias("n")).where("n >= 8")


def corrected(t):
    each = counted(t)
    return op.correct(t, known(each), each)


def aligned(spark, d):
    return op.align_corrected(op.cut(corrected(op.cut(tokens(spark, d)))))


# Corrections need the different tokens and their counts only, not one row for each character.
BARE = """toks AS MATERIALIZED (SELECT unnest(regexp_extract_all(text,'[\\p{L}\\p{N}_'']+|[^\\p{L}\\p{N}_'' \\t\\n\\r]')) AS token FROM documents)"""


@query("h7_word_corrections", f"WITH {FIX.replace(TOK, BARE)} SELECT token, corrected FROM fix WHERE corrected<>token")
def _(spark, d):
    each = counted(tokens(spark, d).select("token"))
    return op.corrections(each, known(each)).where("corrected <> token")


@query("h8_align_corrected_tokens", f"WITH {ALIGNED} SELECT session_id, token_idx, token, corrected, CAST(start_ms AS BIGINT) AS start_ms, CAST(end_ms AS BIGINT) AS end_ms, first_original, last_original, unchanged FROM al")
def _(spark, d):
    return aligned(spark, d).withColumns({c: F.col(c).cast("long") for c in ("start_ms", "end_ms", "first_original", "last_original")})


def rewritten(fixed):
    """Another text: corrected words, repeated words once, words of twelve and more characters in two parts."""
    near = over_slices(fixed, op.S, ["token_idx"], 100_000, lags={"before": "token"})
    half = F.expr("CAST(length(corrected) / 2 AS INT)")
    parts = F.when(F.length("corrected") >= 12, F.array(F.substring("corrected", F.lit(1), half), F.expr("substring(corrected, CAST(length(corrected) / 2 AS INT) + 1)")))
    repeated = F.coalesce(F.lower("token") == F.lower("before"), F.lit(False))
    parts = F.when(repeated, F.array().cast("array<string>")).otherwise(F.coalesce(parts, F.array("corrected")))
    each = near.select(*op.S, "token_idx", parts.alias("parts")).withColumn("n", F.size("parts").cast("long"))
    placed = op.cut(over_slices(each, op.S, ["token_idx"], 100_000, sums={"so_far": "n"}))
    return placed.select(*op.S, (F.col("so_far") - F.col("n")).alias("first"), F.posexplode("parts").alias("at", "token")).select(
        *op.S, (F.col("first") + F.col("at")).alias("token_idx"), "token"
    )


def edits(spark, d):
    t = op.cut(tokens(spark, d).select(*op.S, "token_idx", "token", "start_ms", "end_ms"))
    return editscript.align_edited(t, rewritten(op.cut(corrected(t))))


@query("h8_align_edited_tokens")
def _(spark, d):
    """Tokens of a text with other words, fewer words and more words, aligned to the original."""
    return edits(spark, d)


@query("h9_edit_score")
def _(spark, d):
    return rounded(editscript.edit_score(edits(spark, d)))


@query("h9_correctness_score", f"WITH {ALIGNED} SELECT session_id, count(*) AS n_mapped, count(*) FILTER (unchanged) AS n_unchanged, round(count(*) FILTER (unchanged)/count(*)::DOUBLE,6) AS score FROM al GROUP BY 1")
def _(spark, d):
    """Every token is mapped by its correction, so the score needs no alignment."""
    t = op.cut(tokens(spark, d).select("session_id", "token"))
    fixed = corrected(t).withColumn("unchanged", F.col("token") == F.col("corrected"))
    return rounded(op.score(fixed))


@query(
    "h10_language_summary",
    """WITH u AS (SELECT doc_id AS session_id, CASE WHEN lang='en' THEN 'L' ELSE 'W' END AS grp, length(text) AS n FROM documents UNION ALL SELECT session_id, 'R', count(*) FROM px_words GROUP BY 1),
 c AS (SELECT session_id, CAST(coalesce(sum(n) FILTER (grp='L'),0) AS BIGINT) AS l_chars, CAST(coalesce(sum(n) FILTER (grp='W'),0) AS BIGINT) AS w_chars, CAST(coalesce(sum(n) FILTER (grp='R'),0) AS BIGINT) AS r_words, CAST(0 AS BIGINT) AS s_words FROM u GROUP BY 1)
 SELECT *, l_chars>0 AS has_l, w_chars>0 AS has_w, r_words>0 AS has_r, false AS has_s, l_chars>0 OR w_chars>0 OR r_words>0 AS qualifies FROM c""",
)
def _(spark, d):
    docs = px.table(spark, d, "documents").selectExpr("doc_id AS session_id", "CASE WHEN lang = 'en' THEN 'L' ELSE 'W' END AS grp", "bigint(length(text)) AS n")
    read = px.words(spark, d).groupBy("session_id").agg(F.lit("R").alias("grp"), F.count(F.lit(1)).alias("n"))
    return op.summary(docs.unionByName(read))


@query(
    "h11_element_summary",
    "SELECT element_id, count(*) AS n_units, min(start_ms) AS start_ms, max(end_ms) AS end_ms, round(avg(end_ms-start_ms),3) AS mean_unit_ms, array_to_string(list_sort(list_distinct(list(coalesce(mode,'R')))),',') AS modes FROM px_units GROUP BY 1",
)
def _(spark, d):
    return rounded(op.element_summary(px.units(spark, d)), 3)


@query("h11_element_text", "SELECT element_id, (r-1)//1000 AS piece, string_agg(word,' ' ORDER BY r) AS text FROM (SELECT *, row_number() OVER (PARTITION BY element_id ORDER BY start_ms, idx) AS r FROM px_units) GROUP BY 1,2")
def _(spark, d):
    return op.element_text(px.units(spark, d))


@query(
    "h12_split_modes",
    "SELECT session_id, count(*) FILTER (coalesce(mode,'R')='LR') AS n_lr, count(*) FILTER (coalesce(mode,'R')<>'LR') AS n_r FROM px_words GROUP BY 1",
)
def _(spark, d):
    lr, r = op.split_modes(px.words(spark, d))
    both = lr.select("session_id", F.lit(1).alias("lr")).unionByName(r.select("session_id", F.lit(0).alias("lr")))
    return both.groupBy("session_id").agg(F.count_if(F.col("lr") == 1).alias("n_lr"), F.count_if(F.col("lr") == 0).alias("n_r"))


@query(
    "h13_typing_speed",
    "SELECT session_id, count(*) AS n_chars, round(CASE WHEN max(ts_ms)>min(ts_ms) THEN count(*)/((max(ts_ms)-min(ts_ms))/1000.0::DOUBLE)*60 END,6) AS per_minute FROM px_chars GROUP BY 1",
)
def _(spark, d):
    return rounded(op.typing_speed(px.chars(spark, d)))


@query(
    "h14_correction_view",
    f"WITH {ALIGNED} SELECT session_id, token_idx//200 AS piece, string_agg(token,' ' ORDER BY token_idx) AS original, string_agg(corrected,' ' ORDER BY token_idx) AS corrected, round(count(*) FILTER (unchanged)/count(*)::DOUBLE,6) AS score FROM al GROUP BY 1,2",
)
def _(spark, d):
    return rounded(op.correction_view(aligned(spark, d)))


@query("j3_lang_tokens", f"WITH {TOK}, {WTOK} SELECT 'L' AS grp, count(*) AS n, count(DISTINCT token) AS n_distinct FROM toks UNION ALL SELECT 'R', count(*), count(DISTINCT token) FROM wt")
def _(spark, d):
    heard = tokens(spark, d).select("session_id", "token_idx", "token")
    read = op.word_tokens(op.word_offsets(px.words(spark, d))).select("session_id", "token_idx", "token")
    both = crossquery.lang_tokens({"L": heard, "R": read})
    return both.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("token").alias("n_distinct"))
