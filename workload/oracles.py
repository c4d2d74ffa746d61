"""The registered queries written in plain SQL for an independent engine.

The engine's regular expressions have no look-arounds or back-references, so some
steps are written quite differently from the Spark ones (runs over single characters,
repeated replacement), which makes the comparison worth more.
"""

from __future__ import annotations

from workload.views import CAPS, CHUNK_SIZES, SQL, TIER_OVERRIDES

# fixed values: character classes in the engine's syntax
S = r"\t\n\x0B\f\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
Q = "\"''«»„”“‘’`"  # the apostrophe doubled for SQL
ALNUM = r"\p{L}\p{N}"


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + select.strip()


def _sub(expr: str, pattern: str, replacement: str = "") -> str:
    return f"regexp_replace({expr}, '{pattern}', '{replacement}', 'g')"


def _strip(expr: str) -> str:
    return _sub(expr, rf"^[{S}]+|[{S}]+\z")


def nfkc(t: str) -> str:
    """NFKC of what the views put in; the tables themselves are NFKC."""
    return f"replace(replace(replace(translate({t}, 'ＡＢｃ', 'ABc'), 'ﬁ', 'fi'), 'ﬀ', 'ff'), '…', '...')"


def special_tokens(t: str) -> str:
    return _sub(
        t,
        r"(?i)<\|[^>\n]{1,100}\|>|\[(INST|/INST|ASST|/ASST|SYS|/SYS)\]|<endoftext>|<endofprompt>|<startoftext>",
    )


def urls(t: str) -> str:
    return _sub(t, rf"(?i)https?://[^{S}]+|www\.[^{S}]+|[^{S}]+@[^{S}]+")


def control(t: str) -> str:
    return _sub(t, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]")


def technical(t: str) -> str:
    return _sub(t, r"\[\p{Nd}{1,6}\]|\{[^{}\n]{1,100}\}")


def empty_pairs(t: str) -> str:
    return _sub(t, rf"[{Q}][{S}]*[{Q}]|[(\[{{<][{S}]*[)\]}}>]")


def lonely(t: str) -> str:
    # neighbours share their blank, so every second mark is left for a second pass
    once = _sub(t, rf"([{S}])[{Q}()\[\]{{}}<>]([{S}])", r"\1 \2")
    return _sub(once, rf"([{S}])[{Q}()\[\]{{}}<>]([{S}])", r"\1 \2")


def punct(t: str) -> str:
    t = _sub(t, rf"[{S}]+([,.;:!?])", r"\1")
    t = _sub(t, rf"([,;:!?])([^{S}])", r"\1 \2")
    t = _sub(t, rf"(\.{{3}}|\.)([^{S}.\p{{Nd}}])", r"\1 \2")
    return _sub(t, rf"^([—\-])([^{S}])", r"\1 \2")


def whitespace(t: str) -> str:
    t = _sub(t, r"[ \t]{2,}", " ")
    t = _sub(t, r"\n{2,}", "\n".replace("\n", r"\n"))
    return _strip(t.replace(r"'\n', 'g')", "chr(10), 'g')"))


def squeezed(source: str, out: str, key: str = "doc_id") -> str:
    """CTEs that shorten runs of five or more equal characters, over single characters."""
    return f"""
{out}_chars AS (
  SELECT {key}, unnest(cs) AS ch, generate_subscripts(cs, 1) AS i
  FROM (SELECT {key}, regexp_extract_all(text, '(?s).') AS cs FROM {source})),
{out}_islands AS (
  SELECT {key}, ch, i, i - row_number() OVER (PARTITION BY {key}, ch ORDER BY i) AS g FROM {out}_chars),
{out}_runs AS (
  SELECT {key}, ch, min(i) AS st, count(*) AS n FROM {out}_islands GROUP BY {key}, ch, g),
{out}_texts AS (
  SELECT {key}, string_agg(repeat(ch, CASE WHEN n >= 5 AND ch <> chr(10) THEN 3 ELSE n END), '' ORDER BY st) AS t
  FROM {out}_runs GROUP BY {key}),
{out} AS (
  SELECT s.* EXCLUDE (text), coalesce(t, '') AS text FROM {source} s LEFT JOIN {out}_texts USING ({key}))"""


def _count(t: str, chars: str) -> str:
    return f"length({_sub(t, f'[^{chars}]')})"


def garbage(t: str = "text") -> str:
    n = f"length({t})"
    special = f"length({_sub(t, f'[{ALNUM}{S}]')})"
    return (
        f"({n} < 2 OR {_count(t, r'\p{L}')}::DOUBLE / nullif({n}, 0) < 0.2::DOUBLE"
        f" OR {special}::DOUBLE / nullif({n}, 0) > 0.6::DOUBLE)"
    )


def valid(t: str = "text") -> str:
    weird = f"length({_sub(t, rf'[{ALNUM}_{S}\x{{400}}-\x{{4FF}}.,!?()\-]')})"
    return f"(length({t}) >= 3 AND 1.0::DOUBLE - {weird}::DOUBLE / nullif(length({t}), 0) >= 0.85::DOUBLE)"


def code_hits(t: str = "text") -> str:
    words = "'def','class','import','from','return','lambda','async','await'"
    return (
        f"(length(list_filter(regexp_extract_all({t}, '[{ALNUM}_]+'), lambda w: w IN ({words})))"
        rf" + {_count(t, r'{}\[\];')})"
    )


def cleaned(source: str, out: str, key: str = "doc_id") -> str:
    """CTEs of the whole chain; unusable texts become ''."""
    before = technical(control(urls(special_tokens(nfkc("text")))))
    after = whitespace(punct(lonely(empty_pairs("text"))))
    return f"""
{out}_a AS (
  SELECT * EXCLUDE (text), CASE WHEN text IS NULL OR {garbage()} THEN ''
    ELSE {before} END AS text FROM {source}),
{squeezed(f"{out}_a", f"{out}_b", key).strip()},
{out} AS (SELECT * EXCLUDE (text), {after} AS text FROM {out}_b)"""


KEPT = f"""
usable AS (
  SELECT * FROM dirty WHERE lang IN ('en', 'de') AND text <> '' AND {code_hits()} < 5),
{cleaned("usable", "chain").strip()},
kept AS (SELECT doc_id, lang, source, text FROM chain WHERE {valid()})"""

DIALOGUES = f"""
good AS (
  SELECT *, conv_id * 1000 + turn AS tid, {code_hits()} >= 5 AS code FROM turns),
{cleaned("good", "chain", "tid").strip()},
checked AS (
  SELECT c.conv_id, c.turn, c.role, g.text AS raw, CASE WHEN g.text = '' THEN '' ELSE c.text END AS content,
    g.text = '' OR (NOT c.code AND {valid("c.text")}) AS ok
  FROM chain c JOIN good g USING (tid)),
whole AS (SELECT conv_id FROM checked GROUP BY conv_id HAVING bool_and(ok))"""

def budgets(target: int, stride: int, shortest: int) -> str:
    return f"""
budgets AS (
  SELECT lang, documents, CAST(floor({target} * cpt * 1.15::DOUBLE) AS BIGINT) AS target,
    greatest(CAST(floor({stride} * cpt) AS BIGINT), 1) AS stride, greatest(CAST(floor({shortest} * cpt) AS BIGINT), 1) AS "min"
  FROM (SELECT lang, count(*) AS documents, CASE lang WHEN 'en' THEN 6.0::DOUBLE ELSE 4.0::DOUBLE END AS cpt
        FROM documents GROUP BY lang))"""


BUDGETS = budgets(512, 448, 128)


def chunked(source: str, out: str = "chunks", most: int | None = None, cut: int | None = None) -> str:
    whole = "text" if cut is None else f"substr(text, 1, {cut})"
    limit = "" if most is None else f"WHERE k < {most}"
    return f"""
{out}_windows AS (
  SELECT d.* EXCLUDE (text), substr(text, CAST(i AS BIGINT) + 1, target) AS text, i, b."min" AS shortest
  FROM (SELECT * EXCLUDE (text), {whole} AS text FROM {source}) d JOIN budgets b USING (lang),
    unnest(range(0, length(text), stride)) AS w(i)),
{out} AS (
  SELECT * EXCLUDE (i, shortest), length(text) AS char_count FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS k
    FROM {out}_windows WHERE length(text) >= shortest)
  {limit})"""


HASHED = "hashed AS (SELECT doc_id, source, lang, text, md5('42|' || source || '|' || doc_id || '|0') AS h FROM documents)"
NUMBERED = f"""
{BUDGETS.strip()},
{HASHED},
{chunked("hashed").strip()},
numbered AS (
  SELECT row_number() OVER w - 1 AS id, source, lang, text, char_count,
    coalesce(sum(strlen(text)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS byte_start
  FROM chunks WINDOW w AS (ORDER BY source, h, doc_id, k))"""

PLAN = """
counted AS (SELECT source, count(*) AS num_records FROM documents GROUP BY source),
present AS (SELECT * FROM {sources} JOIN counted USING (source)),
base AS (SELECT coalesce(max(CASE WHEN tier = 1 THEN tier END), min(tier)) AS base_tier FROM present),
base_rows AS (SELECT coalesce(sum(num_records), 0) AS base_total FROM present, base WHERE tier = base_tier),
plan AS (
  SELECT source, tier, content_type, num_records, base_total,
    CASE WHEN NOT coalesce(use_all, FALSE) AND proportion IS NOT NULL
      THEN CAST(floor(base_total * proportion) AS BIGINT) END AS max_rows
  FROM present LEFT JOIN rules USING (source), base_rows)"""

# the trigram slots of every document, and the language of the highest score
SLOT_LISTS = """codes AS (
  SELECT doc_id, lang, list_transform(regexp_extract_all(lower(text), '(?s).'), lambda c: CAST(unicode(c) AS BIGINT)) AS cs FROM documents),
slot_lists AS (
  SELECT doc_id, lang, list_transform(range(1, len(cs) - 1), lambda i: (cs[i] * 104729 + cs[i + 1] * 1299 + cs[i + 2]) % 262139) AS slots
  FROM codes)"""
BEST_LANGUAGE = """scores AS (
  SELECT doc_id, m.lang, sum(n * score) AS score FROM doc_grams g JOIN model m ON {on} GROUP BY doc_id, m.lang),
best AS (SELECT doc_id, lang FROM scores QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) = 1)
SELECT d.doc_id, coalesce(b.lang, 'unknown') AS detected FROM documents d LEFT JOIN best b USING (doc_id)"""
LINES = "SELECT doc_id, line_no, book, {strip} AS line FROM doc_lines"
CAP_VALUES = ", ".join(f"('{lang}', {n})" for lang, n in CAPS.items())

MARKERS = """
markers AS (SELECT * FROM (VALUES
  ('en', ['See also', 'References', 'External links', 'Notes', 'Further reading']),
  ('de', ['Siehe auch', 'Literatur', 'Weblinks', 'Einzelnachweise']),
  ('fr', ['Voir aussi', 'Notes et références', 'Liens externes', 'Bibliographie']),
  ('es', ['Véase también', 'Referencias', 'Enlaces externos', 'Bibliografía'])) t(lang, words))"""

CLEAN_MANIFEST = """
manifest AS (
  SELECT source, n, num_records, languages, r, CASE WHEN r = 1 THEN n % 3 <> 0 ELSE n % 4 <> 0 END AS ok
  FROM (SELECT source, CAST(regexp_extract(source, '(\\d+)', 1) AS INTEGER) AS n, count(*) AS num_records,
          string_agg(DISTINCT lang, ',' ORDER BY lang) AS languages FROM documents GROUP BY source),
    (VALUES (1), (2)) runs(r))"""


def _step(expr: str) -> str:
    return _with(SQL["dirty"], select=f"SELECT doc_id, {expr} AS text FROM dirty")


def _flag(expr: str, name: str) -> str:
    return _with(SQL["dirty"], select=f"SELECT doc_id, CAST({expr} AS INTEGER) AS {name} FROM dirty")


ORACLES: dict[str, str] = {
    "src_min_length": f"""
SELECT doc_id, 0 AS part, lang, t AS text FROM (SELECT *, {_strip("text")} AS t FROM documents)
WHERE length(t) >= 100""",
    "src_unpivot": f"""
WITH wide AS (SELECT *, string_split(text, chr(10)) AS ls FROM documents),
long AS (
  SELECT doc_id, 0 AS part, lang, text FROM wide
  UNION ALL SELECT doc_id, 1, 'en', ls[1] FROM wide
  UNION ALL SELECT doc_id, 2, 'ru', ls[-1] FROM wide
  UNION ALL SELECT doc_id, 3, 'tok', array_to_string(ls[1:3], ' ') FROM wide)
SELECT * FROM (SELECT doc_id, part, lang, {_strip("text")} AS text FROM long) WHERE length(text) >= 100""",
    "src_nested_explode": f"""
SELECT * FROM (
  SELECT doc_id, generate_subscripts(ls, 1) - 1 AS part, lang, {_strip("unnest(ls)")} AS text
  FROM (SELECT *, string_split(text, chr(10)) AS ls FROM documents))
WHERE length(text) >= 100""",
    "src_run_concat": _with(
        SQL["doc_lines"],
        f"stripped AS (SELECT * FROM ({LINES.format(strip=_strip('line'))}) WHERE line <> '')",
        """
flagged AS (
  SELECT *, CASE WHEN lag(book) OVER w IS DISTINCT FROM book OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS s
  FROM stripped WINDOW w AS (ORDER BY doc_id, line_no))""",
        "numbered AS (SELECT *, sum(s) OVER (ORDER BY doc_id, line_no) AS run FROM flagged)",
        select="""
SELECT min(doc_id) AS doc_id, arg_min(line_no, doc_id * 100000 + line_no) AS line_no, any_value(book) AS book,
  string_agg(line, ' ' ORDER BY doc_id, line_no) AS text
FROM numbered GROUP BY run HAVING length(string_agg(line, ' ' ORDER BY doc_id, line_no)) >= 100""",
    ),
    "src_run_concat_lines": _with(
        SQL["doc_lines"],
        f"stripped AS (SELECT * FROM ({LINES.format(strip=_strip('line'))}) WHERE line <> '')",
        """
flagged AS (
  SELECT *, CASE WHEN lag(book) OVER w IS DISTINCT FROM book OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS s
  FROM stripped WINDOW w AS (ORDER BY doc_id, line_no))""",
        "numbered AS (SELECT *, sum(s) OVER (ORDER BY doc_id, line_no) AS run FROM flagged)",
        select="""
SELECT first_value(doc_id) OVER w AS doc_id, first_value(line_no) OVER w AS line_no, book, row_number() OVER w - 1 AS position, line
FROM numbered WINDOW w AS (PARTITION BY run ORDER BY doc_id, line_no)
QUALIFY sum(length(line) + 1) OVER (PARTITION BY run) - 1 >= 100""",
    ),
    "src_group_concat_lines": _with(
        SQL["turns"],
        f"""lines AS (
  SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'en' ELSE 'de' END AS lang, {_strip("text")} AS line FROM turns)""",
        select="""
SELECT conv_id, first_value(turn) OVER w AS turn, first_value(lang) OVER w AS lang, row_number() OVER w - 1 AS position, line
FROM lines WHERE line <> '' WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
QUALIFY sum(length(line) + 1) OVER (PARTITION BY conv_id) - 1 >= 100""",
    ),
    "src_group_concat": _with(
        SQL["turns"],
        f"""lines AS (
  SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'en' ELSE 'de' END AS lang, {_strip("text")} AS line FROM turns)""",
        select="""
SELECT conv_id, min(turn) AS turn, arg_min(lang, turn) AS lang, string_agg(line, chr(10) ORDER BY turn) AS text
FROM lines WHERE line <> '' GROUP BY conv_id HAVING length(string_agg(line, chr(10) ORDER BY turn)) >= 100""",
    ),
    "src_hash_dedup": f"""
WITH answers AS (SELECT doc_id, 0 AS part, 'en' AS lang, {_strip("'Answer: ' || text")} AS text FROM documents),
prompts AS (
  SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn
  FROM (SELECT doc_id, 1 AS part, 'en' AS lang, {_strip("text")} AS text FROM documents) WHERE length(text) >= 100)
SELECT * FROM answers WHERE length(text) >= 100
UNION ALL SELECT doc_id, part, lang, text FROM prompts WHERE rn = 1""",
    "src_lang_cap": f"""
SELECT doc_id, part, lang, text FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn
  FROM (SELECT doc_id, 0 AS part, lang, {_strip("text")} AS text FROM documents)
  WHERE length(text) >= 100) LEFT JOIN (VALUES {CAP_VALUES}) caps(lang, max_rows) USING (lang)
WHERE max_rows IS NULL OR rn <= max_rows""",
    "src_union": f"""
SELECT doc_id, 0 AS part, lang, t AS text FROM (SELECT *, {_strip("text")} AS t FROM documents)
WHERE length(t) >= 100""",
    "src_union_partial": f"""
WITH t AS (SELECT coalesce(lang, '__HIVE_DEFAULT_PARTITION__') AS subset, {_strip("text")} AS t FROM documents),
s AS (SELECT subset, CASE WHEN subset = (SELECT min(subset) FROM t) THEN 0 ELSE 1 END AS ok, length(t) AS n FROM t)
SELECT subset, ok, 1 - ok AS named, CAST(coalesce(sum(CASE WHEN ok = 1 AND n >= 100 THEN 1 END), 0) AS BIGINT) AS records,
       CAST(coalesce(sum(CASE WHEN ok = 1 AND n >= 100 THEN n END), 0) AS BIGINT) AS chars FROM s GROUP BY subset, ok""",
    "landed_json": """
WITH l AS (
  SELECT *, 0 AS kind FROM documents UNION ALL SELECT *, 1 FROM documents WHERE doc_id % 7 = 3
  UNION ALL SELECT *, 2 FROM documents WHERE doc_id % 5 = 2),
n AS (SELECT *, doc_id // 2000 AS part, row_number() OVER (PARTITION BY lang, doc_id // 2000 ORDER BY doc_id, kind) - 1 AS line
      FROM l WHERE lang IS NOT NULL)
SELECT lang, part, line, doc_id AS number, source, text, (SELECT count(*) FROM n WHERE kind = 1) AS bad_lines FROM n WHERE kind = 0""",
    "src_stop_marker": _with(
        SQL["marked"],
        MARKERS,
        f"""
lines AS (
  SELECT doc_id, lang, source, t, ls, list_position(
    list_transform(ls, lambda l: len(list_filter(words, lambda w: starts_with({_strip("l")}, w))) > 0), TRUE) AS stop
  FROM (SELECT *, string_split(t, chr(10)) AS ls FROM (SELECT *, {_strip("text")} AS t FROM marked))
  JOIN markers USING (lang) WHERE length(t) >= 100),
cut AS (
  SELECT doc_id, lang, source,
    CASE WHEN stop > 0 THEN {_strip("array_to_string(ls[1 : stop - 1], chr(10))")} ELSE t END AS text FROM lines)""",
        select="SELECT * FROM cut WHERE length(text) >= 100",
    ),
    "src_schema_project": _with(
        SQL["turns"],
        select="""
SELECT conv_id AS doc_id, 'en' AS lang, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position,
  role, text AS content FROM turns""",
    ),
    "src_select": _with(SQL["sources"], select="SELECT * FROM sources WHERE tier <= 2"),
    "clean_special_tokens": _step(special_tokens("text")),
    "clean_urls": _step(urls("text")),
    "clean_control": _step(control("text")),
    "clean_technical": _step(technical("text")),
    "clean_repeats": _with(SQL["dirty"], squeezed("dirty", "short"), select="SELECT doc_id, text FROM short"),
    "clean_empty_pairs": _step(empty_pairs("text")),
    "clean_lonely": _step(lonely("text")),
    "clean_punct": _step(punct("text")),
    "clean_whitespace": _step(whitespace("text")),
    "nfkc": _step(nfkc("text")),
    "clean_text_full": _with(SQL["dirty"], cleaned("dirty", "chain"), select="SELECT doc_id, text FROM chain"),
    "valid_garbage": _flag(garbage(), "is_garbage"),
    "valid_text": _flag(valid(), "is_valid"),
    "valid_code": _flag(code_hits(), "code_hits"),
    "clean_records": _with(SQL["dirty"], KEPT, select="SELECT * FROM kept"),
    "clean_dialogues": _with(
        SQL["turns"],
        DIALOGUES,
        select="""
SELECT conv_id AS doc_id, 'en' AS lang, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position,
  role, content FROM checked WHERE conv_id IN (SELECT conv_id FROM whole)""",
    ),
    "clean_turns": _with(
        SQL["turns"],
        DIALOGUES,
        select="""
SELECT conv_id, turn, role, content AS text, 'en' AS lang FROM checked
WHERE conv_id IN (SELECT conv_id FROM whole)""",
    ),
    "clean_funnel": _with(
        SQL["dirty"],
        KEPT,
        select="""
SELECT source, rows_in, coalesce(rows_out, 0) AS rows_out, coalesce(languages, '') AS languages
FROM (SELECT source, count(*) AS rows_in FROM dirty GROUP BY source)
LEFT JOIN (SELECT source, count(*) AS rows_out, string_agg(DISTINCT lang, ',' ORDER BY lang) AS languages
           FROM kept GROUP BY source) USING (source)""",
    ),
    "stream_clean": _with(
        "dirty AS (SELECT doc_id, lang, source, text FROM documents)", KEPT, select="SELECT * FROM kept"
    ),
    "mix_plan": _with(
        SQL["sources"], SQL["rules"], PLAN.format(sources="sources"), select="SELECT * FROM plan"
    ),
    "mix_plan_lowest_tier": _with(
        SQL["sources"],
        SQL["rules"],
        "higher AS (SELECT * FROM sources WHERE tier > 1)",
        PLAN.format(sources="higher"),
        select="SELECT * FROM plan",
    ),
    "mix_sample": _with(
        SQL["sources"],
        SQL["rules"],
        PLAN.format(sources="sources"),
        HASHED,
        select="""
SELECT source, doc_id, lang, text FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id) AS rn FROM hashed WHERE text <> '')
JOIN plan USING (source) WHERE content_type = 'text' AND (max_rows IS NULL OR rn <= max_rows)""",
    ),
    "mix_sample_in_order": _with(
        SQL["sources"],
        SQL["rules"],
        PLAN.format(sources="sources"),
        select="""
SELECT source, doc_id, lang, text FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents WHERE text <> '')
JOIN plan USING (source) WHERE content_type = 'text' AND (max_rows IS NULL OR rn <= max_rows)""",
    ),
    "tier_override": _with(
        SQL["sources"],
        SQL["rules"],
        f"""
moved AS (SELECT s.source, coalesce(t, tier) AS tier, content_type FROM sources s
          LEFT JOIN (VALUES {", ".join(f"('{s}', {t})" for s, t in TIER_OVERRIDES.items())}) o(source, t) USING (source))""",
        PLAN.format(sources="moved").replace("CASE WHEN tier = 1", "CASE WHEN tier = 2"),
        select="SELECT * FROM plan",
    ),
    "chunk_budgets": _with(BUDGETS, select="SELECT * FROM budgets"),
    "chunk_text": _with(
        BUDGETS,
        chunked("(SELECT doc_id, lang, text FROM documents)"),
        select="SELECT doc_id, lang, k, text, char_count FROM chunks",
    ),
    "chunk_text_short_windows": _with(
        """
budgets AS (
  SELECT lang, CAST(floor(32 * cpt * 1.15::DOUBLE) AS BIGINT) AS target,
    CAST(28 * cpt AS BIGINT) AS stride, CAST(8 * cpt AS BIGINT) AS "min"
  FROM (SELECT DISTINCT lang, CASE lang WHEN 'en' THEN 6.0::DOUBLE ELSE 4.0::DOUBLE END AS cpt FROM documents))""",
        chunked("(SELECT doc_id, lang, text FROM documents)", most=20, cut=3000),
        select="SELECT doc_id, lang, k, text, char_count FROM chunks",
    ),
    "chunk_multi_size": "SELECT * FROM ("
    + ") UNION ALL SELECT * FROM (".join(
        _with(
            budgets(size, size * 7 // 8, size // 4),
            chunked("(SELECT doc_id, lang, text FROM documents)"),
            select=f"SELECT doc_id, lang, {size} AS target_tokens, k, text, char_count FROM chunks",
        )
        for size in CHUNK_SIZES
    )
    + ")",
    "compression_ratio": _with(
        BUDGETS,
        chunked("(SELECT doc_id, lang, text FROM documents)"),
        select="SELECT CAST(sum(strlen(text)) AS BIGINT) AS raw_bytes, count(*) AS rows, 1 AS smaller FROM chunks",
    ),
    "chat_export": _with(
        SQL["turns"],
        DIALOGUES,
        """
sized AS (SELECT conv_id AS doc_id, count(*) AS n_messages, CAST(ceil(sum(length(content)) / 6.0::DOUBLE) AS BIGINT) AS est_tokens
          FROM checked WHERE conv_id IN (SELECT conv_id FROM whole) GROUP BY conv_id)""",
        select="""
SELECT row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) - 1 AS position, doc_id, 'en' AS lang, n_messages, est_tokens
FROM sized WHERE n_messages >= 2 AND est_tokens <= 600""",
    ),
    "chunk_ids": _with(NUMBERED, select="SELECT id, source, lang, text, char_count FROM numbered"),
    "dense_index": _with(
        SQL["doc_lines"],
        select="""
SELECT doc_id, book, line_no, line, row_number() OVER (ORDER BY doc_id, line_no) - 1 AS row_index FROM doc_lines""",
    ),
    "lang_stats": _with(
        BUDGETS,
        chunked("(SELECT doc_id, lang, text FROM documents)"),
        select="SELECT lang, count(*) AS records, sum(char_count) AS chars FROM chunks GROUP BY lang",
    ),
    "corpus_stats": _with(
        SQL["dirty"],
        KEPT,
        BUDGETS,
        chunked("kept"),
        select="SELECT lang, count(*) AS records, sum(char_count) AS chars FROM chunks GROUP BY lang",
    ),
    "shard_assign": _with(
        NUMBERED,
        select="""
SELECT id, CAST(byte_start AS BIGINT) AS byte_start, CAST(byte_start AS BIGINT) // 100000 AS shard FROM numbered""",
    ),
    "global_shuffle": _with(
        NUMBERED,
        select="""
SELECT id, source, lang, text, char_count, row_number() OVER (ORDER BY md5('42|' || id), id) - 1 AS position
FROM numbered""",
    ),
    "sink_roundtrip": _with(
        NUMBERED,
        select="""
SELECT lang, count(*) AS records, sum(char_count) AS chars, (SELECT count(*) FROM numbered) AS rows_written
FROM numbered GROUP BY lang""",
    ),
    "stage_metrics": """
SELECT source, count(*) AS num_records, string_agg(DISTINCT lang, ',' ORDER BY lang) AS languages
FROM documents GROUP BY source""",
    "stage_pending": _with(
        SQL["sources"],
        CLEAN_MANIFEST,
        select="""
SELECT * FROM sources WHERE source NOT IN (SELECT source FROM manifest WHERE r = 2 AND ok AND n % 5 <> 0)""",
    ),
    "stage_latest": _with(
        CLEAN_MANIFEST,
        select="""
SELECT source, 'cleaning' AS stage, CAST(ok AS INTEGER) AS ok, num_records, languages FROM manifest WHERE r = 2""",
    ),
    # the half of a document is the first character of its keys; a model's keys carry the other half
    "lang_detect": f"""
WITH {SLOT_LISTS},
grams AS (SELECT doc_id, lang, doc_id % 2 AS half, unnest(slots) AS slot FROM slot_lists),
counts AS (SELECT half, lang, slot, count(*) AS n FROM grams WHERE lang IS NOT NULL GROUP BY half, lang, slot),
totals AS (SELECT half, lang, sum(n) AS total FROM counts GROUP BY half, lang),
vocabulary AS (SELECT DISTINCT half, slot FROM counts),
sizes AS (SELECT half, count(*) AS v FROM vocabulary GROUP BY half),
model AS (
  SELECT 1 - v.half AS half, v.slot, t.lang, CAST(floor(ln(CAST(coalesce(c.n, 0) + 1 AS DOUBLE)
    / CAST(t.total + z.v AS DOUBLE)) * 1000000) AS BIGINT) AS score
  FROM vocabulary v JOIN totals t ON t.half = v.half JOIN sizes z ON z.half = v.half
  LEFT JOIN counts c ON c.half = v.half AND c.lang = t.lang AND c.slot = v.slot),
doc_grams AS (SELECT doc_id, half, slot, count(*) AS n FROM grams GROUP BY doc_id, half, slot),
{BEST_LANGUAGE.format(on="m.half = g.half AND m.slot = g.slot")}""",
    "detect_stored_model": f"""
WITH {SLOT_LISTS},
grams AS (SELECT doc_id, lang, unnest(slots) AS slot FROM slot_lists),
counts AS (SELECT lang, slot, count(*) AS n FROM grams WHERE lang IS NOT NULL GROUP BY lang, slot),
totals AS (SELECT lang, sum(n) AS total FROM counts GROUP BY lang),
vocabulary AS (SELECT DISTINCT slot FROM counts),
model AS (
  SELECT v.slot, t.lang, CAST(floor(ln(CAST(coalesce(c.n, 0) + 1 AS DOUBLE)
    / CAST(t.total + (SELECT count(*) FROM vocabulary) AS DOUBLE)) * 1000000) AS BIGINT) AS score
  FROM vocabulary v CROSS JOIN totals t LEFT JOIN counts c ON c.lang = t.lang AND c.slot = v.slot),
doc_grams AS (SELECT doc_id, slot, count(*) AS n FROM grams GROUP BY doc_id, slot),
{BEST_LANGUAGE.format(on="m.slot = g.slot")}""",
    "detect_by_script": """
WITH letters AS (
  SELECT doc_id, length(regexp_replace(text, '[^\u0400-\u04FF]', '', 'g')) AS cyrillic,
    length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS latin FROM documents)
SELECT doc_id, CASE WHEN cyrillic > 0 AND cyrillic >= latin THEN 'ru' WHEN latin > 0 THEN 'en' ELSE 'unknown' END AS detected
FROM letters""",
}
