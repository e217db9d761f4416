"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import Scratch
from .chat_format import format_chats, read_loss, read_turns
from .cohort_matrix import cohort_matrix
from .decontaminate import decontaminate
from .hmm import score_texts
from .language_id import fit_languages, identify_languages
from .line_dedup import line_dedup
from .near_dedup import near_duplicates
from .quality_classifier import draw, fit_quality, score_quality
from .quality_rules import BOILERPLATE, BOILERPLATE_WORDS, MOST_LOST_PERCENT, SEPARATORS, SHOUTS, STOPS, quality_rules
from .sentencepiece_codec import decode, encode_batches, load_model
from .token_alignment import DIGEST, align_tokenizers, digests
from .token_counts import build_trees, edit_trees
from .warc import read_warc, write_warc

TOKENIZERS = os.environ.get("SPARKLOOM_TOKENIZERS", "/opt/tokenizers")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), k=2, percent=80)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"), ["doc_id"]).drop("clean_text")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of all documents, and three edits to each: words put in, a stretch taken out, a stretch replaced."""
    at = lambda share: F.floor(F.length(F.coalesce("text", F.lit(""))) * F.lit(share)).cast("int")
    edit = lambda place, removed, added: F.struct(place.alias("at"), F.lit(removed).alias("removed"), added.alias("added"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    edits = F.array(edit(at(0.3), 0, F.concat(F.lit(" (see entry "), F.col("doc_id").cast("string"), F.lit(") "))), edit(at(0.6), 40, F.lit("")), edit(at(0.9), 12, F.lit("\n\nAddendum: it's 2024. ")))
    vocabulary = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
    counted = edit_trees(build_trees(docs, vocabulary).withColumn("edits", edits), vocabulary, ["doc_id"])
    return counted.select("doc_id", "n_tokens_before", "n_tokens", "n_leaves", "reencoded_chars", F.sha2("text", 256).alias("text_sha256"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents").select("doc_id", "text"), _remainder(7) == 2)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(said).alias("text"))
    chats = format_chats(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more))
    read = chats.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"), ["doc_id"])
    joined = F.array_join(F.col("items").cast("array<string>"), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(joined, 256).alias("items_sha256"), "contaminated")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup(_table(spark, sf_dir, "documents"), columns=["doc_id"])
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = load_model(spark, f"{TOKENIZERS}/piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared()
        for rows, ids, first in encode_batches(batches, pieces):
            buf, offsets = decode(pieces, ids, first)
            texts = rows.column("text")
            back = [(t.as_buffer().to_pybytes() if t.is_valid else b"").replace(b"\xe2\x96\x81", b" ") == buf[a:b].tobytes() for t, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True)]
            raw = np.ascontiguousarray(ids, "<i4")
            digests = [hashlib.sha256(raw[a:b].data).hexdigest() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(first)), pa.array(digests), pa.array(back)], names=["doc_id", "n_tokens", "ids_sha256", "round_trip"])

    return _table(spark, sf_dir, "documents").select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, round_trip boolean")


def _remainder(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).filter(_remainder(5) != 0)
    scored = score_quality(docs, fit_quality(draw(docs, labels)), ["doc_id"])
    return scored.select("doc_id", (_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    folder = scratch.path("archives")
    files = scratch.save(write_warc(_table(spark, sf_dir, "pages"), folder), "files")
    page = lambda name: F.nullif(F.regexp_extract(name, "^<urn:page:(.*)>$", 1), F.lit("")).cast("long")
    whole = F.when(F.col("kind") == "gap", F.raise_error(F.concat(F.lit("damaged archive: "), "path", F.lit(": "), "reason")).cast("boolean"))
    read = read_warc(files, folder, with_payload=False).filter(whole.otherwise(F.col("kind").isin("response", "revisit")))
    return read.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), page("refers_to").alias("refers_to"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
    return align_tokenizers(_table(spark, sf_dir, "documents"), a, b, ["doc_id"], digests, DIGEST)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = fit_languages(docs.filter(_remainder(5) != 0))
    named = identify_languages(docs.select("doc_id", "text"), model, ["doc_id"], with_spans=False)
    return named.select("doc_id", (_remainder(5) == 0).alias("held_out"), "lang_pred", "score")


def op13_cohort_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was known before February 2024, and all."""
    h = F.crc32(F.col("click_id").cast("string").cast("binary"))
    late = F.when(h % 3 == 0, (h % 100).cast("int")).otherwise(0)
    arrives = F.col("arrived_at") + F.make_dt_interval(F.coalesce(late, F.lit(0)))
    known = [arrives < F.to_timestamp_ntz(F.lit("2024-02-01 00:00:00")), F.lit(True)]
    return cohort_matrix(_table(spark, sf_dir, "clicks"), _table(spark, sf_dir, "clients"), known, F.col("kind") == "error")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_token_counts": op3_token_counts,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_chat_format": op5_chat_format,
    "op6_decontaminate": op6_decontaminate,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_warc": op10_warc,
    "op11_token_alignment": op11_token_alignment,
    "op12_language_id": op12_language_id,
    "op13_cohort_retention": op13_cohort_retention,
}

_OP1 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
                      WHEN len(ws) = 1 THEN [ws[1]]
                      ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS sh
  FROM w),
n AS (SELECT doc_id, len(sh)::BIGINT AS n FROM s),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
ranked AS (
  SELECT e.doc_id, n.n, e.g, row_number() OVER (PARTITION BY e.doc_id ORDER BY f.c, e.g) AS r
  FROM e JOIN (SELECT g, count(*) AS c FROM e GROUP BY g) f USING (g) JOIN n USING (doc_id)),
prefix AS (SELECT * FROM ranked WHERE r <= n - ceil(0.8 * n) + 1),
cand AS (
  SELECT DISTINCT a.doc_id AS u, b.doc_id AS v
  FROM prefix a JOIN prefix b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
common AS (
  SELECT u, v, count(*) AS c FROM cand JOIN e x ON x.doc_id = u JOIN e y ON y.doc_id = v AND x.g = y.g GROUP BY u, v),
links AS (
  SELECT u, v FROM common JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 80 * (a.n + b.n - c)),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM n
  UNION
  SELECT b.v, r.c FROM reach r JOIN both_ways b ON b.u = r.doc_id WHERE r.c < b.v)
SELECT n.doc_id, n.n AS n_shingles, min(reach.c) AS component_id, min(reach.c) = n.doc_id AS kept
FROM n JOIN reach USING (doc_id) GROUP BY n.doc_id, n.n
"""

_SPACE = r"[\x20\x09-\x0D]"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str, gap: str = _SPACE) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{gap}+'), lambda x: x <> '')"


def _chars(text: str, kinds: str) -> str:
    return f"length(regexp_replace({text}, '[^{kinds}]', '', 'g'))"


_OP2 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_words("coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM d WHERE len(ws) >= 3),
win2 AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c FROM win),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM win2 WHERE c > 1) GROUP BY doc_id),
l0 AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d),
l1 AS (SELECT doc_id, l, {_words("l")} AS lw FROM l0),
l AS (SELECT doc_id, l, len(lw) AS nw, {_chars("l", SEPARATORS)} + len(list_filter(lw, lambda x: x = '/')) AS parts, {_chars("l", r"^\x20\x09-\x0D").replace("[^^", "[")} AS cps FROM l1),
f AS (
  SELECT doc_id, l, cps,
    (nw >= 10 AND NOT regexp_matches(l, '[{STOPS}]')) OR (nw >= 3 AND {_chars("l", SHOUTS)} > nw) OR 10 * {_chars("l", "#*$%&|<>")} > cps
    OR (parts >= 3 AND 4 * parts >= nw)
    OR (nw <= {BOILERPLATE_WORDS} AND regexp_matches({_LOWER.format("l")}, '{"|".join(BOILERPLATE)}')) AS bad
  FROM l WHERE nw > 0),
g AS (SELECT doc_id, count(*) - count(DISTINCT l) AS dup, sum(CASE WHEN bad THEN cps ELSE 0 END) AS lost, count(*) FILTER (bad) AS failed FROM f GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words, {_chars("t", r"^\x20\x09-\x0D").replace("[^^", "[")}::BIGINT AS word_chars, {_chars("t", "#*$%&|<>")}::BIGINT AS n_symbols,
    coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS lost_chars, coalesce(failed, 0)::BIGINT AS n_failed_lines
  FROM d LEFT JOIN g USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND 100 * lost_chars <= {MOST_LOST_PERCENT} * word_chars AS kept FROM b
"""

_OP5 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (
  SELECT *, length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS n, coalesce(lag(role) OVER w = role, false) AS goes_on
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n + CASE WHEN goes_on THEN 10 ELSE 24 + length(role) END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

_ALNUM_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_OP6 = rf"""
WITH d AS (SELECT doc_id, {_words(_LOWER.format("coalesce(text, '')"), _ALNUM_GAP)} AS ws FROM documents),
b AS (SELECT item_id, {_words(_LOWER.format("coalesce(text, '')"), _ALNUM_GAP)} AS ws FROM benchmark WHERE item_id IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS g
  FROM (SELECT item_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM (SELECT *, least(13, len(ws)) AS k FROM b WHERE len(ws) > 0))),
dw AS (
  SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(ws) >= k)),
h AS (SELECT doc_id, k, i, item_id FROM dw JOIN bw USING (k, g)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(hits.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hits.n > 0 AND 20 * hits.n >= len(ws), false) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, encode(coalesce(html, '')) AS b FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM p),
bits AS (
  SELECT page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + bin_at, 1), '' ORDER BY g) AS d
  FROM (
    SELECT page_id, g, (((('0x' || substr(sha1(h), 1 + 10 * (g // 8), 10))::BIGINT) >> (35 - 5 * (g % 8))) & 31)::INTEGER AS bin_at
    FROM (SELECT page_id, h, unnest(range(32)) AS g FROM p))
  GROUP BY page_id)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, d AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f JOIN bits USING (page_id)
"""

_OP8 = rf"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM s),
k AS (SELECT *, {_LOWER.format(f"regexp_replace(l, '^{_SPACE}+|{_SPACE}+$', '', 'g')")} AS key FROM l),
c AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, coalesce(c.top <> k.doc_id, false) AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

_OP13 = """
WITH table_rows AS (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM (SELECT unnest(range(256)) AS i)),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM table_rows),
ids AS (SELECT DISTINCT click_id AS id FROM clicks WHERE click_id IS NOT NULL UNION SELECT client_id FROM clicks WHERE client_id IS NOT NULL),
crc AS (
  SELECT id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
                             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM ids, crc_table),
c AS (
  SELECT e.client_id, epoch_us(ts) AS us, kind, coalesce(floor(100 * value + 0.5), 0)::BIGINT AS cents,
    arrived_at + to_days(CASE WHEN h % 3 = 0 THEN (h % 100)::INTEGER ELSE 0 END) < TIMESTAMP '2024-02-01' AS early
  FROM (SELECT DISTINCT * FROM clicks) e LEFT JOIN crc ON crc.id = e.click_id
  WHERE ts IS NOT NULL AND e.client_id IS NOT NULL),
k AS (SELECT 1 AS state, * FROM c UNION ALL SELECT 0, * FROM c WHERE early),
starts AS (SELECT state, client_id, min(us) AS began FROM k WHERE kind = 'error' GROUP BY ALL),
weeks AS (SELECT *, floor(floor(began / 86400000000.0) / 7.0)::BIGINT AS cohort FROM starts),
two AS (SELECT client_id, (count(DISTINCT cohort) > 1)::BIGINT AS moved FROM weeks GROUP BY client_id),
own AS (SELECT client_id, min(source) AS source FROM clients GROUP BY client_id),
users AS (
  SELECT k.state, coalesce(own.source, '') AS segment, cohort, (us - began) // 604800000000 AS period, k.client_id, moved, sum(cents) AS cents
  FROM k JOIN weeks w ON w.state = k.state AND w.client_id = k.client_id AND us >= began JOIN two ON two.client_id = k.client_id LEFT JOIN own ON own.client_id = k.client_id
  GROUP BY ALL)
SELECT state::INTEGER AS state, segment, cohort, period, count(*) AS users, sum(h)::BIGINT AS users_crc32, sum(moved)::BIGINT AS moved, sum(cents)::BIGINT AS cents
FROM users JOIN crc ON crc.id = users.client_id GROUP BY ALL
"""

ORACLES: dict[str, str] = {"op1_near_dedup": _OP1, "op2_quality_rules": _OP2, "op5_chat_format": _OP5, "op6_decontaminate": _OP6, "op8_line_dedup": _OP8, "op10_warc": _OP10, "op13_cohort_retention": _OP13}
