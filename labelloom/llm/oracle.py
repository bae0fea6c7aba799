"""DuckDB SQL of the registered queries that SQL can express."""

from labelloom.llm import decontaminate, jaccard_join, near_dups
from labelloom.llm.quality_rules import BITS, POLICIES, RULES
from labelloom.llm.queries import POLICY
from labelloom.llm.words import WORD

_WORDS = f"regexp_extract_all(text, '{WORD}')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _passes(policy: str) -> str:
    return f"bit_count(failed & {POLICIES[policy].mask}) <= {POLICIES[policy].allowed}"


_FAILED = " + ".join(f"CASE WHEN {r.fails} THEN {BITS[r.name]} ELSE 0 END" for r in RULES)

QUALITY = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, {_WORDS} AS words FROM d),
windows AS (
    SELECT doc_id, i, words[i:i + 4] AS run
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)
),
repeated AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS times FROM windows
),
covered AS (
    SELECT doc_id, count(*) AS n
    FROM (SELECT DISTINCT doc_id, i + unnest(range(5)) AS word FROM repeated WHERE times > 1) GROUP BY doc_id
),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
lined AS (
    SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id
),
m AS (
    SELECT w.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(c.n, 0) AS n_repeat_words,
           length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
           length(regexp_replace(text, '[^a-z]', '', 'g')) AS n_lower
    FROM w LEFT JOIN covered c ON w.doc_id = c.doc_id LEFT JOIN lined l ON w.doc_id = l.doc_id
),
ledger AS (SELECT *, CAST({_FAILED} AS INTEGER) AS failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       NOT ({_passes("base")}) AS base_failed, ({_passes("base")}) AND ({_passes(POLICY)}) AS kept, failed
FROM ledger
"""


def _shingles(table: str, key: str, width: int) -> str:
    """Distinct shingles of lower-cased texts; fewer words than the width make one shingle."""
    return f"""
    SELECT DISTINCT {key}, array_to_string(words[i:i + {width - 1}], ' ') AS shingle
    FROM (SELECT {key}, words, unnest(range(1, greatest(len(words) - {width - 1}, 1) + 1)) AS i
          FROM (SELECT {key}, regexp_extract_all({_LOWER}, '{WORD}') AS words FROM {table})
          WHERE len(words) > 0)
    """


DECONTAMINATE = f"""
WITH wanted AS ({_shingles("benchmark", "item_id", decontaminate.WIDTH)}),
sizes AS (SELECT item_id, count(*) AS item_shingles FROM wanted GROUP BY item_id),
held AS ({_shingles("documents", "doc_id", decontaminate.WIDTH)}),
shared AS (SELECT doc_id, item_id, count(*) AS shared_shingles FROM held JOIN wanted USING (shingle) GROUP BY ALL)
SELECT doc_id, item_id, CAST(shared_shingles AS BIGINT) AS shared_shingles,
       CAST(item_shingles AS BIGINT) AS item_shingles, shared_shingles / item_shingles AS containment
FROM shared JOIN sizes USING (item_id) WHERE 100 * shared_shingles >= {decontaminate.THRESHOLD} * item_shingles
"""


def _near_dups(width: int, threshold: int, kept: str) -> str:
    return f"""
WITH RECURSIVE shingles AS ({_shingles("documents", "doc_id", width)}),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id != b.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM shared JOIN sizes s ON a = s.doc_id JOIN sizes t ON b = t.doc_id
    WHERE 100 * shared.n >= {threshold} * (s.n + t.n - shared.n)
),
reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id{kept}
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


NEAR_DUPS = _near_dups(near_dups.WIDTH, near_dups.THRESHOLD, ", d.doc_id = component_id AS kept")
JACCARD_JOIN = _near_dups(jaccard_join.WIDTH, jaccard_join.THRESHOLD, "")

_CONTROL = r"[<\[](/?s>|/?INST\]|\|(part\||(image|audio|document):))"
# Length of a text once escaped: every backslash and every control string takes one character more.
_ESCAPED = f"""2 * length(text) - length(replace(text, chr(92), ''))
           + len(regexp_extract_all(text, '{_CONTROL}'))"""

CHAT = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
said AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
           coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS learned,
           sum(length(role) + 1 + CASE WHEN role = 'assistant' THEN 7 ELSE 13 END + {_ESCAPED}) AS formatted_chars
    FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
       sha256(learned) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM said
"""

# CRC-32 by its rule: the table of all bytes, then a byte at a time. ``bytes`` is a list of numbers.
_CRC_TABLE = """crc AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                              lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS i))
)"""


def _crc32(numbers: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, {numbers}),
                       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


def _bytes(text: str) -> str:
    """Of texts up to U+00FF."""
    return f"""flatten(list_transform(string_split({text}, ''),
                       lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END))"""


def _encoded(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_encoded, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE},
given AS (
    SELECT doc_id, source, {_leaf('text')} AS leaf,
           CASE WHEN {_crc32(_bytes("CAST(doc_id AS VARCHAR)"))} % 2 = 0
                THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS found
    FROM documents, crc
),
nodes AS (
    SELECT source, 0 AS lvl, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place, leaf AS digest,
           count(*) OVER (PARTITION BY source) AS n
    FROM given
    UNION ALL
    SELECT source, lvl + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 2) // 3
    FROM nodes WHERE n > 1 GROUP BY source, lvl, place // 3
),
upper_nodes AS (
    SELECT source AS of, 0 AS lvl, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, digest, count(*) OVER () AS n
    FROM nodes WHERE n = 1
    UNION ALL
    SELECT CAST(NULL AS VARCHAR), lvl + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 2) // 3
    FROM upper_nodes WHERE n > 1 GROUP BY lvl, place // 3
),
runs AS (
    SELECT source, lvl, place // 3 AS run, list(digest ORDER BY place) AS digests FROM nodes WHERE n > 1 GROUP BY ALL
),
upper_runs AS (
    SELECT lvl, place // 3 AS run, list(digest ORDER BY place) AS digests FROM upper_nodes WHERE n > 1 GROUP BY ALL
),
climbed AS (
    SELECT doc_id, source, leaf, 0 AS lvl, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place, found AS now, '' AS proof
    FROM given
    UNION ALL
    SELECT doc_id, c.source, leaf, c.lvl + 1, place // 3,
           sha256(array_to_string(digests[:place % 3], '') || now || array_to_string(digests[place % 3 + 2:], '')),
           proof || array_to_string(digests[:place % 3], '') || array_to_string(digests[place % 3 + 2:], '')
    FROM climbed c JOIN runs r ON c.source IS NOT DISTINCT FROM r.source AND c.lvl = r.lvl AND place // 3 = run
),
subs AS (
    SELECT c.doc_id, c.leaf, t.digest AS subroot, u.place, now, proof
    FROM climbed c JOIN nodes t ON c.source IS NOT DISTINCT FROM t.source AND t.n = 1 AND c.lvl = t.lvl
    JOIN upper_nodes u ON u.lvl = 0 AND c.source IS NOT DISTINCT FROM u.of
),
over AS (
    SELECT doc_id, leaf, subroot, 0 AS lvl, place, now, proof FROM subs
    UNION ALL
    SELECT doc_id, leaf, subroot, c.lvl + 1, place // 3,
           sha256(array_to_string(digests[:place % 3], '') || now || array_to_string(digests[place % 3 + 2:], '')),
           proof || array_to_string(digests[:place % 3], '') || array_to_string(digests[place % 3 + 2:], '')
    FROM over c JOIN upper_runs r ON c.lvl = r.lvl AND place // 3 = run
)
SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, now AS folded_root, now = t.digest AS verified
FROM over JOIN upper_nodes t ON t.n = 1 AND t.lvl = over.lvl
"""

# Base 32 of a digest in hex: five hex digits are four letters.
_BASE32 = """array_to_string(list_transform(range(32),
           lambda i: alphabet[((digits[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31) + 1]), '')"""

WARC = f"""
WITH hashed AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' AS alphabet FROM pages
),
spelt AS (
    SELECT *, list_transform(range(8), lambda i: CAST('0x' || hex[5 * i + 1:5 * i + 5] AS INTEGER)) AS digits,
           min(page_id) OVER (PARTITION BY html) AS least
    FROM hashed
)
SELECT page_id, strlen(html) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id != least THEN least END AS refers_to, true AS intact
FROM spelt
"""

_LETTERS = "[A-Za-z" + chr(0xC0) + "-" + chr(0xFF) + "]+"

SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_LETTERS}')) AS run FROM documents
),
hashed AS (
    SELECT run, n, length(run) AS size, {_crc32(_bytes("CAST(doc_id AS VARCHAR) || ':' || run"))} AS h
    FROM (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL), crc
),
words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT CASE WHEN h % 97 = 0 THEN run[:h % size] || run[h % size + 2:] ELSE run END AS word, n FROM hashed
    ) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
),
cut AS (
    SELECT word, n, i, word[:i - 1] || word[i + 1:] AS shorter, word[:i - 1] AS a, word[i + 1:] AS b
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
near AS (
    SELECT DISTINCT cut.word AS x, words.word AS y FROM cut JOIN words ON shorter = words.word
    UNION SELECT words.word, cut.word FROM cut JOIN words ON shorter = words.word
    UNION SELECT c.word, d.word FROM cut c JOIN cut d ON c.i = d.i AND c.a = d.a AND c.b = d.b AND c.word != d.word
),
best AS (
    SELECT x, count(*) AS n_near, max(n) AS most FROM near JOIN words ON y = word GROUP BY x
),
forms AS (
    SELECT x AS word, min(y) AS form, any_value(most) AS form_n
    FROM near JOIN best USING (x) JOIN words w ON y = w.word AND w.n = most JOIN words o ON x = o.word
    WHERE most >= 2 * o.n GROUP BY x
),
led AS (
    SELECT word, word AS root FROM words
    UNION ALL
    SELECT led.word, form FROM led JOIN forms ON led.root = forms.word
)
SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, form, form_n, root
FROM words w LEFT JOIN best ON w.word = x LEFT JOIN forms f ON w.word = f.word
JOIN led l ON w.word = l.word AND l.root NOT IN (SELECT word FROM forms)
"""

SQL = {
    "op6_warc": WARC,
    "op13_jaccard_join": JACCARD_JOIN,
    "op12_spelling": SPELLING,
    "op11_merkle": MERKLE,
    "op5_chat": CHAT,
    "op1_quality_rules": QUALITY,
    "op2_decontaminate": DECONTAMINATE,
    "op10_near_dups": NEAR_DUPS,
}
