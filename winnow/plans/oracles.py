"""What the registered queries must return, as SQL over the same tables for another engine.

Nothing is imported from the operators: prompts, patterns and hash rules are stated again on purpose.
"""

from __future__ import annotations

INTRO = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request."
)

# java.util.Random(42): the first three (a, b) pairs, stated as a check on the rule in the package.
BAND_COEFFICIENTS = ((1562431131, 117392763), (1467211249, 102948884), (662969971, 2023087525))

PUNCTUATION = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"
UNPRINTABLE = r"[\x00-\x08\x0b-\x1f\x7f-\x{9f}\p{Cf}]"
SPACES = r"[\t\n\x0b\f\r\x1c-\x1f\x{85}\p{Z} ]+"
PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "CARD": r"\b(?:[0-9]{4}[ -]?){3}[0-9]{4}\b",
    "IP": r"\b(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\b",
    "PHONE": (
        r"\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}\b|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}\b"
        r"|\b[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}\b|\b00[1-9][0-9]{0,2}[ -][0-9]{1,4}[ -][0-9]{4,8}\b"
        r"|\b0[1-9][0-9]{1,3}[ /-][0-9]{5,8}\b"
    ),
}


def random_pairs(count: int) -> list[tuple[int, int]]:
    """Coefficients by the documented java.util.Random rule, written down again for the oracle."""
    seed, numbers = (42 ^ 25214903917) % 2**48, []
    while len(numbers) < 2 * count:
        seed = (seed * 25214903917 + 11) % 2**48
        bits = seed // 2**17
        if bits - bits % 2038074742 + 2038074741 < 2**31:
            numbers.append(bits % 2038074742)
    return [(1 + numbers[2 * i], numbers[2 * i + 1]) for i in range(count)]


# Texts are cut into overlapping blocks first: taking 13 characters out of a long text costs its length.
def prints(source: str, key: str, text: str) -> str:
    return f"""
    blocks AS (
      SELECT {key} AS k, {text} AS t, unnest(range(0, length({text}) - 12, 256)) AS p
      FROM {source} WHERE length({text}) >= 13),
    parts AS (SELECT k, substr(t, p + 1, 268) AS part FROM blocks),
    spots AS (SELECT k, part, unnest(range(1, length(part) - 11)) AS i FROM parts),
    digests AS (SELECT k, sha1(substr(part, i, 13)) AS h FROM spots),
    prints AS (
      SELECT k, CAST('0x' || substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2)
                AS BIGINT) & 1073741823 AS x
      FROM digests)"""


def hashes(pairs) -> list[str]:
    return [f"CAST(min(((1 + x) * {a} + {b}) % 2038074743) AS INTEGER)" for a, b in pairs]


def bands(source: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    h1, h2, h3 = hashes(BAND_COEFFICIENTS)
    return f"""{prints(source, key, text)},
    bands AS (SELECT k AS {key}, {h1} AS hash1, {h2} AS hash2, {h3} AS hash3 FROM prints GROUP BY k),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY hash1, hash2, hash3 ORDER BY {key}) AS DupRank,
             min({key}) OVER (PARTITION BY hash1, hash2, hash3) AS survivor
      FROM bands)"""


def training(instruction: str, context: str) -> str:
    return (
        f"'{INTRO} ### Instruction ' || {instruction} || ' ' || CASE WHEN length({context}) > 1 THEN "
        f"' Use the additional input context: ' || {context} || ' ' ELSE '' END || ' ### Response '"
    )


def replaced(text: str) -> str:
    for label, pattern in PATTERNS.items():
        text = f"regexp_replace({text}, '{pattern}', '{label}', 'g')"
    return text


def found(text: str) -> str:
    lists = []
    for label, pattern in PATTERNS.items():
        lists.append(f"list_transform(regexp_extract_all({text}, '{pattern}'), lambda w: {{'word': w, 'label': '{label}'}})")
        text = f"regexp_replace({text}, '{pattern}', '{label}', 'g')"
    return f"list_concat({', '.join(lists)})"


def scrubbed(text: str) -> str:
    """Literal replacement in the order of the entities, folded by a list of [text, label] steps."""
    steps = f"list_transform({found(text)}, lambda e: [e.word, e.label])"
    return f"list_reduce({steps}, lambda out, e: [replace(out[1], e[1], e[2])], [{text}])[1]"


TURN_PAIRS = """
    pairs AS (
      SELECT a.conv_id, a.turn, a.text AS prompt, b.text AS response
      FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
      WHERE a.role = 'user' AND b.role = 'assistant')"""

STANDARD = f"""{TURN_PAIRS},
    standard AS (
      SELECT printf('%012d-%06d', conv_id, turn) AS key, {scrubbed('prompt')} AS prompt, {scrubbed('response')} AS response,
             'conversations' AS source
      FROM pairs
      UNION ALL
      SELECT printf('%012d', doc_id), {training('text', 'lang')}, source, 'documents'
      FROM (SELECT doc_id, {scrubbed('text')} AS text, {scrubbed('lang')} AS lang, {scrubbed('source')} AS source FROM documents))"""

SILVER = f"""{STANDARD},
    silver AS (SELECT row_number() OVER (ORDER BY source, key) - 1 AS id, * FROM standard)"""

NORMALIZED = (
    f"trim(regexp_replace(translate(lower(text), '{PUNCTUATION}', ''), '{SPACES}', ' ', 'g'))"
)
SPLIT = "CASE WHEN CAST('0x' || substr(sha1('42:' || {}), 1, 8) AS BIGINT) / 4294967296.0 < 0.7 THEN 'train' ELSE 'test' END"
BAND = "hash1, hash2, hash3"
KEPT = f"WITH {bands()} SELECT doc_id, text, source, {BAND} FROM ranked JOIN documents USING (doc_id) WHERE DupRank "

ORACLES: dict[str, str] = {
    "near_dup_keep": KEPT + "= 1",
    "near_dup_quarantine": f"""WITH {bands()}
    SELECT doc_id, text, source, {BAND}, 'near_duplicate' AS reason FROM ranked JOIN documents USING (doc_id) WHERE DupRank > 1
    UNION ALL SELECT doc_id, text, source, NULL, NULL, NULL, CASE WHEN text IS NULL THEN 'null_text' ELSE 'too_short' END
    FROM documents WHERE text IS NULL OR length(text) < 13""",
    "near_dup_bucket_rank": f"WITH {bands()} SELECT doc_id, {BAND}, DupRank FROM ranked",
    "near_dup_bucket_sizes": (
        f"WITH {bands()} SELECT {BAND}, count(*) AS n_rows, CAST(count(*) * (count(*) - 1) // 2 AS BIGINT) AS n_pairs "
        f"FROM bands GROUP BY {BAND} HAVING count(*) > 1"
    ),
    "near_dup_pairs": f"WITH {bands()} SELECT survivor AS a_id, doc_id AS b_id FROM ranked WHERE DupRank > 1",
    "near_dup_pair_scores": f"""WITH {bands()},
    signed AS (
      SELECT k, [{', '.join(hashes(random_pairs(128)))}] AS hashes FROM prints
      WHERE k IN (SELECT unnest([doc_id, survivor]) FROM ranked WHERE DupRank > 1) GROUP BY k)
    SELECT survivor AS a_id, doc_id AS b_id,
           round(CAST(CAST(len(list_distinct(list_intersect(a.hashes, b.hashes))) AS DOUBLE)
                 / (256 - len(list_distinct(list_intersect(a.hashes, b.hashes)))) AS FLOAT)::DOUBLE, 6) AS score,
           round(len(list_filter(range(1, 129), lambda i: a.hashes[i] = b.hashes[i])) / 128.0::DOUBLE, 6) AS equal_share
    FROM ranked JOIN signed a ON a.k = survivor JOIN signed b ON b.k = doc_id WHERE DupRank > 1""",
    "minhash_signatures": (
        f"WITH {prints('documents', 'doc_id', 'text')} "
        f"SELECT k AS doc_id, concat_ws(',', {', '.join(hashes(random_pairs(128)))}) AS hashes FROM prints GROUP BY k"
    ),
    "band_hashes": f"WITH {bands()} SELECT doc_id, {BAND} FROM bands",
    "shingle_counts": f"""WITH {prints('documents', 'doc_id', 'text')},
    sums AS (SELECT k, count(DISTINCT x) AS n, min(x) AS lowest, max(x) AS highest FROM prints GROUP BY k)
    SELECT doc_id, CAST(greatest(length(text) - 12, 0) AS INTEGER) AS n_shingles,
           CAST(coalesce(n, 0) AS INTEGER) AS n_fingerprints,
           CAST(lowest AS INTEGER) AS lowest, CAST(highest AS INTEGER) AS highest
    FROM documents LEFT JOIN sums ON k = doc_id""",
    "lowercase": "SELECT doc_id, lower(text) AS text FROM documents",
    "strip_punctuation": f"SELECT doc_id, translate(text, '{PUNCTUATION}', '') AS text FROM documents",
    "collapse_whitespace": f"SELECT doc_id, trim(regexp_replace(text, '{SPACES}', ' ', 'g')) AS text FROM documents",
    "normalize_text": f"SELECT doc_id, {NORMALIZED} AS text FROM documents",
    "remove_bad_characters": (
        f"SELECT doc_id, regexp_replace(text, '{UNPRINTABLE}', '', 'g') AS text FROM documents"
    ),
    "nfc_text": "SELECT doc_id, nfc_normalize(text) AS text FROM documents",
    "text_length": (
        "SELECT doc_id, CAST(length(text) AS INTEGER) AS n, length(text) > 50 AS long FROM documents"
    ),
    "min_length_filter": (
        f"SELECT * FROM (SELECT doc_id, {NORMALIZED} AS text FROM documents) WHERE length(text) > 50"
    ),
    "prompt_training": (
        f"SELECT doc_id, {training('text', 'context')} AS prompt "
        "FROM (SELECT *, substr(lang, 1, CAST(doc_id % 3 AS INTEGER)) AS context FROM documents)"
    ),
    "prompt_inference": (
        f"SELECT conv_id, turn, '{INTRO} ### Instruction ' || text || ' ### Response' || chr(10) "
        "AS prompt FROM conversations WHERE role = 'user'"
    ),
    "prompt_serving": (
        f"SELECT conv_id, turn, '{INTRO}' || chr(10) || chr(10) || '### Instruction:' || chr(10) "
        "|| text || chr(10) || chr(10) || '### Response:' || chr(10) AS prompt FROM conversations WHERE role = 'user'"
    ),
    "stop_token_cut": "SELECT doc_id, split_part(text || '<|endoftext|>', '<|endoftext|>', 1) AS answer FROM documents",
    "reply_extract": "SELECT doc_id, text AS answer FROM documents",
    "reply_candidates": (
        "SELECT doc_id, CAST(0 AS INTEGER) AS candidate, text AS answer FROM documents "
        "UNION ALL SELECT doc_id, 1, lang FROM documents UNION ALL SELECT doc_id, 2, source FROM documents"
    ),
    "json_extract": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "sql_functions": f"""SELECT doc_id, {NORMALIZED} AS cleaned, {training('text', 'lang')} AS prompt,
      '{INTRO} ### Instruction ' || text || ' ### Response' || chr(10) AS asked,
      '{INTRO}' || chr(10) || chr(10) || '### Instruction:' || chr(10) || text || chr(10) || chr(10) || '### Response:' || chr(10) AS served,
      translate(text, '{PUNCTUATION}', '') AS stripped, trim(regexp_replace(text, '{SPACES}', ' ', 'g')) AS collapsed,
      regexp_replace(text, '{UNPRINTABLE}', '', 'g') AS printable, nfc_normalize(text) AS composed,
      {replaced('text')} AS scrubbed, {scrubbed('text')} AS replaced, text AS reply,
      split_part(text, '<|endoftext|>', 1) AS answer,
      round(CAST(CASE WHEN n_chars = 3 THEN 1.0 ELSE 0.5 END AS DOUBLE), 6) AS score FROM documents""",
    "rule_pii_scrub": f"SELECT doc_id, {replaced('text')} AS text FROM documents",
    "entity_scrub": (
        f"SELECT doc_id, {scrubbed('text')} AS text, CAST(len({found('text')}) AS INTEGER) AS n_entities FROM documents"
    ),
    "entity_scrub_detector": (
        "SELECT doc_id, list_reduce(list_transform(list_filter(regexp_extract_all(text, '[A-Z0-9]{3,}'), "
        "lambda w: length(w) > 3), lambda w: [w]), "
        "lambda out, w: [replace(out[1], w[1], 'CODE')], [text])[1] AS text FROM documents"
    ),
    "standardize_sources": f"WITH {STANDARD} SELECT *, '2024-01-01 00:00:00' AS stamped FROM standard",
    "consolidate_ids": f"WITH {SILVER} SELECT id, prompt, response, source FROM silver",
    "gold_set": f"""WITH {SILVER}, {bands('silver', 'id', 'prompt')}
    SELECT prompt, response, source FROM silver JOIN ranked USING (id) WHERE DupRank = 1""",
    "quality_quarantine": f"""SELECT doc_id, reason FROM (
      SELECT doc_id, concat_ws(',', CASE WHEN text IS NULL THEN 'null_text' END,
        CASE WHEN lang IS NULL THEN 'null_lang' END, CASE WHEN length(text) < 13 THEN 'too_short' END,
        CASE WHEN length({NORMALIZED}) <= 50 THEN 'below_threshold' END) AS reason
      FROM (SELECT doc_id, CASE WHEN doc_id % 97 <> 0 THEN text END AS text, nullif(lang, 'es') AS lang FROM documents))
    WHERE reason <> ''""",
    "upsert_by_id": """SELECT doc_id, text, CASE WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
      THEN 'target' ELSE 'inserted' END AS origin FROM documents d""",
    "upsert_by_band": f"""WITH {bands()},
    en AS (SELECT min(doc_id) AS doc_id, {BAND} FROM bands JOIN documents USING (doc_id) WHERE lang = 'en' GROUP BY {BAND}),
    other AS (SELECT min(doc_id) AS doc_id, {BAND} FROM bands JOIN documents USING (doc_id) WHERE lang <> 'en' GROUP BY {BAND})
    SELECT * FROM en UNION ALL SELECT * FROM other WHERE NOT EXISTS (
      SELECT 1 FROM en WHERE en.hash1 = other.hash1 AND en.hash2 = other.hash2 AND en.hash3 = other.hash3)""",
    "latest_per_key": """SELECT user_id, version, event_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY version DESC, event_id DESC) AS place FROM (
        SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS version FROM events)) WHERE place = 1""",
    "load_strings": (
        "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents"
    ),
    "load_splits": (
        "SELECT 'train' AS split, text FROM documents UNION ALL SELECT 'test', text FROM benchmark"
    ),
    "load_declared": f"WITH {TURN_PAIRS} SELECT prompt, response, 'conversations' AS source FROM pairs",
    "table_lifecycle": f"""WITH {TURN_PAIRS} SELECT prompt, response, 'conversations' AS source FROM pairs
      UNION ALL SELECT text, lang, 'documents' FROM documents""",
    "compact_table": "SELECT * FROM documents",
    "preview": "SELECT doc_id, source, text FROM documents ORDER BY doc_id LIMIT 20",
    "hash_split": f"SELECT doc_id, {SPLIT.format('text')} AS split FROM documents",
    "export_manifest": f"""WITH {TURN_PAIRS} SELECT {SPLIT.format('prompt')} AS split, 8 AS n_shards,
      count(*) AS n_rows, CAST(sum(strlen(prompt) + strlen(response)) AS BIGINT) AS text_bytes FROM pairs GROUP BY 1""",
    "export_verify": f"""WITH {TURN_PAIRS} SELECT count(*) AS expected_rows, count(*) AS written_rows,
      0 AS expected_nulls, 0 AS written_nulls, 0 AS missing_rows, 0 AS extra_rows FROM pairs""",
    "jsonl_roundtrip": f"WITH {TURN_PAIRS} SELECT prompt, response FROM pairs",
    "batch_inference": f"""SELECT item_id, request, request AS answer FROM (
      SELECT item_id, '{INTRO}' || chr(10) || chr(10) || '### Instruction:' || chr(10) || text || chr(10) || chr(10)
        || '### Response:' || chr(10) AS request FROM benchmark)""",
    "stream_bronze": "SELECT event_id, user_id, event_type, value, props, true AS stamped FROM events",
    "stream_silver": (
        f"SELECT doc_id, {training('text', 'lang')} AS prompt FROM "
        f"(SELECT doc_id, lang, {scrubbed('text')} AS text FROM documents)"
    ),
    "stream_dedup": KEPT + "= 1",
    "stream_drop_repeats": f"WITH {bands()} SELECT DISTINCT {BAND} FROM bands",
}
ORACLES["export_gold"] = f"""SELECT split, format, count(*) AS n_rows, CAST(sum(length(prompt)) AS BIGINT) AS n_chars
  FROM (SELECT *, {SPLIT.format('prompt')} AS split FROM ({ORACLES['gold_set']})),
    (SELECT unnest(['shards', 'jsonl']) AS format) GROUP BY split, format"""
ORACLES["stream_keep_apart"] = """WITH RECURSIVE e AS (
    SELECT min(event_id) AS event_id, user_id, event_type, epoch_us(ts) AS micros FROM events GROUP BY user_id, event_type, ts
  ), kept AS (
    SELECT user_id, event_type, min(micros) AS micros FROM e GROUP BY user_id, event_type
    UNION ALL
    SELECT k.user_id, k.event_type, min(e.micros) FROM kept k JOIN e USING (user_id, event_type)
    WHERE e.micros > k.micros + 6 * 3600 * 1000000::BIGINT GROUP BY k.user_id, k.event_type
  )
  SELECT event_id, user_id, event_type, micros FROM kept JOIN e USING (user_id, event_type, micros)"""
ORACLES["paged_source"] = "SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, value, props FROM events"
ORACLES["stream_paged"] = ORACLES["paged_source"]
ORACLES["export_samples"] = f"""WITH {TURN_PAIRS}
  SELECT sample, true AS same FROM (SELECT unnest(range(0, count(*), 7)) AS sample FROM pairs)"""
ORACLES["compact_small_files"] = "SELECT * FROM documents"
ORACLES["repair_text"] = "SELECT doc_id, text FROM documents"
ORACLES["resumed_inference"] = f"""WITH sent AS (
    SELECT doc_id, length('{INTRO}' || '### Instruction:' || text || '### Response:') + 6 AS n FROM documents)
  SELECT doc_id, n % 3 = 0 AS failed_first, n || ' characters' AS answer, CAST(NULL AS VARCHAR) AS error,
    CAST(CASE WHEN n % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS runs FROM sent"""
ORACLES["table_upsert"] = ORACLES["upsert_by_id"]
ORACLES["gold_view"] = ORACLES["gold_set"]
