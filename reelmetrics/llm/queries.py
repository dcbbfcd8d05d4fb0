"""The operators as queries over a folder of tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmetrics.llm import (
    decontam,
    exact_dedup,
    langid,
    licenses,
    lm,
    merkle,
    mixing,
    ngram_join,
    pii,
    prefix_trie,
    quality,
    simhash,
    warc,
)
from reelmetrics.sources.scratch import scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write_archive(_table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "intact", "complete",
        F.octet_length("record").cast("bigint").alias("record_bytes"), F.sha2("record", 256).alias("record_sha256"),
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    shares = [F.col("p")[k].alias(f"p_{name}") for k, name in enumerate(mixing.TARGETS)]
    return mixed.select("doc_id", "n_tokens", *shares, "rate")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    found = F.col("contamination")
    return marked.select(
        "doc_id",
        found["n_words"].alias("n_words"),
        found["n_hit"].alias("n_hit"),
        found["n_items"].alias("n_items"),
        F.sha2(found["items"].cast("binary"), 256).alias("items_sha256"),
        found["contaminated"].alias("contaminated"),
    )


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_groups(_table(spark, sf_dir, "documents"), keep="largest")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(_table(spark, sf_dir, "documents"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(_table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    proven = merkle.merkle_manifest(_table(spark, sf_dir, "documents"), claim=merkle.lower_case_some())
    return proven.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.proof_text().cast("binary"), 256).alias("proof_sha256"),
        merkle.folded().alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc,
        op2_licenses,
        op3_mixing,
        op4_quality,
        op5_language,
        op6_simhash,
        op7_decontamination,
        op8_lm,
        op9_exact_dedup,
        op10_pii,
        op11_ngram_join,
        op12_merkle,
        op13_conversation_trie,
    )
}

# -- SQL -------------------------------------------------------------------------------

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _base32(digest: str) -> str:
    """SQL for the base 32 of 40 hexadecimal digits: four numbers of eight digits."""
    alphabet = warc.BASE32_RFC4648
    digits = [
        f"substr('{alphabet}', CAST((CAST('0x' || substr({digest}, {at}, 10) AS BIGINT) >> {shift}) & 31 AS BIGINT) + 1, 1)"
        for at in (1, 11, 21, 31)
        for shift in range(35, -1, -5)
    ]
    return " || ".join(digits)


_EOL = "chr(13) || chr(10)"
_URL = "replace(replace(url, chr(13), '%0D'), chr(10), '%0A')"
_OP1 = f"""
WITH hashed AS (
  SELECT page_id, url, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS holder
  FROM pages),
digested AS (
  SELECT *, {_base32('h')} AS payload_digest, page_id IS NOT DISTINCT FROM holder AS own,
         'HTTP/1.1 200 OK' || {_EOL} || 'Content-Type: text/html; charset=utf-8' || {_EOL} || 'Content-Length: ' || payload_bytes || {_EOL} || {_EOL} AS http
  FROM hashed),
restored AS (
  SELECT *, 'WARC/1.1' || {_EOL} || 'WARC-Type: ' || CASE WHEN own THEN 'response' ELSE 'revisit' END || {_EOL}
         || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), 'null') || '>' || {_EOL}
         || coalesce('WARC-Target-URI: ' || {_URL} || {_EOL}, '') || 'WARC-Date: 1970-01-01T00:00:00Z' || {_EOL}
         || 'WARC-Payload-Digest: sha1:' || payload_digest || {_EOL}
         || CASE WHEN own THEN '' ELSE 'WARC-Refers-To: <urn:page:' || holder || '>' || {_EOL} || 'WARC-Profile: {warc.REVISIT_PROFILE}' || {_EOL} END
         || 'Content-Type: application/http; msgtype=response' || {_EOL}
         || 'Content-Length: ' || (octet_length(encode(http)) + CASE WHEN own THEN payload_bytes ELSE 0 END) || {_EOL} || {_EOL}
         || http || CASE WHEN own THEN html ELSE '' END || {_EOL} || {_EOL} AS record
  FROM digested)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN own THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN NOT own THEN holder END AS refers_to, true AS intact, true AS complete,
       CAST(octet_length(encode(record)) AS BIGINT) AS record_bytes, sha256(record) AS record_sha256
FROM restored"""


def _op2() -> str:
    phrases = ", ".join(f"('{label}', string_split('{p}', ' '))" for p, label in licenses.PHRASES.items())
    templates = ", ".join(
        f"('{label}', string_split('{' '.join(sorted(set(t.split())))}', ' '), {licenses.block_words(t)})"
        for label, t in licenses.TEMPLATES.items()
    )
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, {_WORDS.format('text')} AS words FROM documents),
phrases(label, parts) AS (VALUES {phrases}),
templates(label, parts, size) AS (VALUES {templates}),
places AS (
  SELECT row, label, unnest(list_filter(range(len(words)), lambda i: words[i + 1 : i + len(parts)] = parts)) AS place
  FROM docs JOIN phrases ON list_contains(words, parts[1])),
base AS (
  SELECT row, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels FROM places GROUP BY row),
blocks AS (
  SELECT row, label, parts, size, words, unnest(range(len(words))) AS i
  FROM docs JOIN templates ON len(list_intersect(words, parts)) >= 0.8 * len(parts) - 1e-9),
contained AS (
  SELECT row, label, len(list_intersect(words[i + 1 : i + size], parts)) / len(parts) AS share FROM blocks WHERE list_contains(parts, words[i + 1])),
found AS (SELECT row, list(DISTINCT label) AS labels, max(share) AS share FROM contained WHERE share >= 0.8 - 1e-9 GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(base.labels, found.labels))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN CAST(1 AS DOUBLE) ELSE coalesce(CAST(share AS DOUBLE), 0) END AS score
FROM docs LEFT JOIN base USING (row) LEFT JOIN found USING (row)"""


_OP7 = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS.format('text')} AS words FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS.format('text')} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, words[i + 1 : i + {decontam.WINDOW_WORDS}] AS w
  FROM (SELECT item_id, words, unnest(range(greatest(1, len(words) - {decontam.WINDOW_WORDS - 1}))) AS i FROM items WHERE len(words) > 0)),
lengths AS (SELECT DISTINCT len(w) AS n FROM windows),
grams AS (
  SELECT row, n, i, words[i + 1 : i + n] AS w
  FROM (SELECT row, words, n, unnest(range(len(words) - n + 1)) AS i FROM docs, lengths WHERE len(words) >= n)),
hits AS (SELECT row, item_id, n, i FROM grams JOIN windows USING (w)),
covered AS (SELECT row, count(*) AS n_hit FROM (SELECT DISTINCT row, unnest(range(i, i + n)) AS place FROM hits) GROUP BY row),
named AS (
  SELECT row, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids FROM hits GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (row) LEFT JOIN named USING (row)"""

_OP9 = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_LOWER.format('text')} AS t FROM documents) WINDOW same AS (PARTITION BY t)"""

# The table of crc32, and the crc32 of a text of digits. A row of crc_table must be in scope.
_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc)"""


def _crc32(text: str) -> str:
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii(substr({text}, i, 1)) AS BIGINT))"
    step = "lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), {step}), 4294967295)"


def _op12(heights: int = 8) -> str:
    """The tree in ``heights`` levels of eight, which is enough for 8^heights documents of a language."""

    def framed(value: str) -> str:
        return f"coalesce(CAST(octet_length(encode({value})) AS VARCHAR) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return f"sha256({' || '.join(map(framed, values))})"

    def tree(name: str) -> list[str]:
        parts = []
        for k in range(heights):
            run = f"PARTITION BY grp, place // {merkle.FANOUT} ORDER BY place"
            parts.append(
                f"""{name}_by{k} AS (
  SELECT grp, place, coalesce(string_agg(digest, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k} WHERE n > 1)"""
            )
            parts.append(
                f"""{name}{k + 1} AS (
  SELECT grp, place // {merkle.FANOUT} AS place, sha256(string_agg(digest, '' ORDER BY place)) AS digest, (n + {merkle.FANOUT - 1}) // {merkle.FANOUT} AS n
  FROM {name}{k} WHERE n > 1 GROUP BY grp, place // {merkle.FANOUT}, n)"""
            )
        tops = " UNION ALL ".join(f"SELECT grp, digest FROM {name}{k} WHERE n = 1" for k in range(heights + 1))
        return [*parts, f"{name}_top AS ({tops})"]

    def climb(source: str, name: str, grp: str, place: str, before: str) -> list[str]:
        steps = []
        for k in range(heights):
            steps.append(
                f"""{before}{k + 1} AS (
  SELECT c.* REPLACE (CASE WHEN s.l IS NULL THEN fold ELSE sha256(s.l || fold || s.r) END AS fold, proof || coalesce(s.l || s.r, '') AS proof)
  FROM {source if k == 0 else f'{before}{k}'} c LEFT JOIN {name}_by{k} s ON s.grp IS NOT DISTINCT FROM c.{grp} AND s.place = c.{place} // {merkle.FANOUT**k})"""
            )
        return steps

    tampered = _LOWER.format("text").replace("coalesce(text, '')", "text")
    return ", ".join(
        [
            f"WITH {_CRC_TABLE}",
            f"""leaves AS (
  SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {leaf(tampered)} ELSE {leaf('text')} END AS claim
  FROM documents, crc_table)""",
            "placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves)",
            "t0 AS (SELECT lang AS grp, place, leaf AS digest, count(*) OVER (PARTITION BY lang) AS n FROM placed)",
            *tree("t"),
            "u0 AS (SELECT 0 AS grp, row_number() OVER (ORDER BY encode(grp) NULLS FIRST) - 1 AS place, digest, count(*) OVER () AS n, grp AS lang FROM t_top)",
            *tree("u"),
            "start AS (SELECT doc_id, leaf, lang, place, claim AS fold, '' AS proof FROM placed)",
            *climb("start", "t", "lang", "place", "f"),
            f"mid AS (SELECT f{heights}.* REPLACE (u0.place AS place), 0 AS every, u0.digest AS subroot FROM f{heights} JOIN u0 ON u0.lang IS NOT DISTINCT FROM f{heights}.lang)",
            *climb("mid", "u", "every", "place", "g"),
        ]
    ) + f"""
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = digest AS verified
FROM g{heights}, u_top"""


_OP13 = f"""
WITH {_CRC_TABLE},
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
lengths AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id),
convs AS (
  SELECT c.*, {_crc32('CAST(c.conv_id AS VARCHAR)')} % {prefix_trie.MOST_GIVEN} AS h, b.conv_id AS first, coalesce(b.n, 0) AS n_first
  FROM (SELECT *, conv_id - conv_id % {prefix_trie.HUNDRED} AS first FROM lengths) c LEFT JOIN lengths b ON b.conv_id = c.first, crc_table),
rebuilt AS (
  SELECT c.conv_id, place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.first WHERE place < h
  UNION ALL SELECT conv_id, place - h + least(h, n_first), role, text FROM convs JOIN turns USING (conv_id) WHERE place >= h),
seqs AS (
  SELECT conv_id, coalesce(s, []) AS seq FROM convs LEFT JOIN (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY place) AS s FROM rebuilt GROUP BY conv_id) USING (conv_id)),
paths AS (SELECT conv_id, unnest(range(len(seq) + 1)) AS depth, seq FROM seqs),
nodes AS (
  SELECT depth, seq[1:depth] AS key, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(seq) = depth), '') AS ends,
         coalesce(length(key[depth].text), 0) AS chars
  FROM paths GROUP BY depth, seq[1:depth]),
kids AS (SELECT depth - 1 AS depth, key[1:depth - 1] AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
known AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (depth, key)),
below AS (
  SELECT d AS depth, key[1:d] AS key, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM known) GROUP BY d, key[1:d])
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(k.ends) AS ends_sha256
FROM known k JOIN below b ON b.depth = k.depth AND b.key = k.key LEFT JOIN nodes p ON p.depth = k.depth - 1 AND p.key = k.key[1:k.depth - 1]"""

#: The others are checked by tests against brute force, round trips or held-out accuracy.
ORACLE_SQL: dict[str, str] = {
    "op1_warc": _OP1,
    "op2_licenses": _op2(),
    "op7_decontamination": _OP7,
    "op9_exact_dedup": _OP9,
    "op12_merkle": _op12(),
    "op13_conversation_trie": _OP13,
}
