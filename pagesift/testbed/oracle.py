"""The same queries as SQL for another engine, written from the definitions."""

from __future__ import annotations

from pagesift import fixed
from pagesift.functions.hashing import signed64
from pagesift.testbed import data


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_text(v) for v in values)


def _with(*ctes: str, select: str) -> str:
    seen = list(dict.fromkeys(c.strip() for c in ctes))
    return "WITH " + ",\n".join(seen) + "\n" + select


TITLE = "regexp_extract(html, '<title>(.*?)</title>', 1)"


def _site(x: str) -> str:
    return f"regexp_extract({x}, '(http[:s/]+[^/]+/)', 1)"


def _strict(x: str) -> str:
    return f"regexp_extract({x}, '(http[:s/]+[a-z.]+/)', 1)"


def _trim(x: str) -> str:
    return rf"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def _clean(x: str) -> str:
    return f"regexp_replace(replace({_trim(x)}, chr(10), ' '), '<.*?>', ' ', 'g')"


def _tokens(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}]+')"


def _letters(x: str) -> str:
    return rf"regexp_replace({x}, '[^\p{{L}}]+', ' ', 'g')"


def _clean_tokens(x: str) -> str:
    return _tokens(_clean(x))


def _hash_tokens(x: str) -> str:
    return f"list_filter({_tokens(_letters(x))}, lambda w: length(w) >= 2)"


CRAWL = f"""crawl AS (
  SELECT doc_id AS fid, url AS furl, {TITLE} AS ftitle, lang AS fkeywords, text AS fcontent, source AS src_type,
    strftime(DATE '2024-01-01' + (doc_id % 30)::INT, '%Y%m%d') AS stat_date
  FROM documents JOIN pages ON page_id = doc_id // 4)"""
WANTED = f"wanted AS (SELECT * FROM crawl WHERE src_type IN ({_list(data.SOURCES)}))"


def _signed(unsigned: str) -> str:
    return (
        f"(CASE WHEN {unsigned}::HUGEINT > 9223372036854775807 "
        f"THEN {unsigned}::HUGEINT - 18446744073709551616 ELSE {unsigned}::HUGEINT END)::BIGINT"
    )


MD5_64 = "('0x' || substr(md5({0}), 1, 16))::UBIGINT"
_BYTES = (
    "list_transform(range(1, length(hex(encode({0}))), 2), "
    "lambda i: ('0x' || substr(hex(encode({0})), i, 2))::HUGEINT)"
)
FNV_64 = (
    "list_reduce(list_prepend(14695981039346656037::HUGEINT, " + _BYTES + "), "
    "lambda h, b: (xor(h, b) * 1099511628211::HUGEINT) % 18446744073709551616::HUGEINT)::UBIGINT"
)


# Words and hashes


def _hash_ctes(token_hash: str, words: str, name: str = "hashes") -> list[str]:
    """``words`` is a CTE of (fid, token) with a null token for empty texts."""
    bits = [f"sum(((h >> {j}) & 1)::INT) AS b{j}" for j in range(64)]
    value = " | ".join(
        f"(CASE WHEN b{j} * 2 > n THEN {1 << j}::UBIGINT ELSE 0::UBIGINT END)" for j in range(64)
    )
    return [
        f"token_hash AS (SELECT token, {token_hash.format('token')} AS h FROM (SELECT DISTINCT token FROM {words}))",
        f"bits AS (SELECT fid, count(h) AS n, {', '.join(bits)} FROM {words} LEFT JOIN token_hash USING (token) "
        "GROUP BY fid)",
        f"unsigned_hash AS (SELECT fid, {value} AS u FROM bits)",
        f"{name} AS (SELECT fid, {_signed('u')} AS hash FROM unsigned_hash)",
    ]


HASH_WORDS = f"""hash_words AS (
  SELECT doc_id AS fid, unnest(CASE WHEN len(t) = 0 THEN [NULL] ELSE t END) AS token
  FROM (SELECT doc_id, {_hash_tokens('text')} AS t FROM documents))"""
CONTENT_WORDS = f"""content_words AS (
  SELECT doc_id AS fid, lang, unnest(CASE WHEN len(t) = 0 THEN [NULL] ELSE t END) AS token
  FROM (SELECT doc_id, lang, {_clean_tokens('text')} AS t FROM documents))"""
TITLE_WORDS = f"""title_words AS (
  SELECT fid, unnest(CASE WHEN len(t) = 0 THEN [NULL] ELSE t END) AS token
  FROM (SELECT fid, {_clean_tokens('ftitle')} AS t FROM crawl))"""
LEXICON = f"""lexicon AS (
  SELECT word, CASE length(word) % 3 WHEN 0 THEN 'v' WHEN 1 THEN 'n' ELSE 'nz' END AS nature
  FROM (SELECT DISTINCT unnest({_tokens(TITLE)}) AS word FROM pages))"""

HOST_RULES = f"""host_rules AS (
  SELECT host, min(label) AS label FROM (
    SELECT regexp_extract(url, '{data.HOST}', 1) AS host, regexp_extract(url, '{data.PATH_LANG}', 1) AS label FROM pages)
  WHERE host <> '' AND label <> '' GROUP BY host)"""

HASHES = [HASH_WORDS, *_hash_ctes(MD5_64, "hash_words")]
EXACT = [
    *HASHES,
    "exact AS (SELECT hash, min(fid) AS fid, count(*)::BIGINT AS samelen FROM hashes GROUP BY hash)",
]


def _absorb(source: str, block: int, name: str, by: str = "") -> list[str]:
    """One greedy pass as a fold over each bucket; ``by`` is ``"stat_date, "`` or empty."""
    mask = f"({signed64(fixed.BLOCK_MASKS[block])})::BIGINT"
    near = "bit_count(xor(l, {0})) <= 1"
    return [
        f"""{name}_bucket AS (
  SELECT {by}hash & {mask} AS m,
    list({{'fid': fid, 'hash': hash, 'samelen': samelen, 'hashes': hashes}} ORDER BY samelen DESC, fid) AS members
  FROM {source} GROUP BY ALL)""",
        f"""{name}_led AS (
  SELECT {by}m, members, list_reduce(list_transform(members, lambda r: [r.hash]),
    lambda acc, x: CASE WHEN len(list_filter(acc, lambda l: {near.format('x[1]')})) > 0
      THEN acc ELSE list_concat(acc, x) END) AS leaders
  FROM {name}_bucket)""",
        f"{name}_row AS (SELECT {by}m, leaders, unnest(members) AS r FROM {name}_led)",
        f"""{name}_placed AS (
  SELECT {by}r, list_filter(leaders, lambda l: {near.format('r.hash')})[1] AS lead FROM {name}_row)""",
        f"""{name} AS (
  SELECT {by}arg_min(r.fid, {{'neg': -r.samelen, 'fid': r.fid}}) AS fid, lead AS hash,
    list(r.fid ORDER BY r.samelen DESC, r.fid) AS absorbed, sum(r.samelen)::BIGINT AS samelen,
    flatten(list(r.hashes)) AS hashes
  FROM {name}_placed GROUP BY {by}lead)""",
    ]


def _near(source: str = "exact", by: str = "") -> list[str]:
    keys = f"{by}hash, fid, samelen"
    ctes = [f"start AS (SELECT {keys}, [hash] AS hashes FROM {source})"]
    previous = "start"
    for block in range(4):
        ctes += _absorb(previous, block, f"pass{block}", by)
        previous = f"pass{block}"
    return ctes


SHOWN = "fid, hash, array_to_string(absorbed, ',') AS samefid, samelen"
REPORT_ROW_OK = (
    "(furl IS NULL OR (NOT (" + " OR ".join(f"contains(furl, {_text(p)})" for p in data.RULES.blocked) + ")"
    f" AND ftitle IS NOT NULL AND NOT contains(ftitle, {_text(data.RULES.search_home)})"
    f" AND fcontent IS NOT NULL AND NOT starts_with(fcontent, {_text(data.ERROR_PREFIX)})))"
)


def _report(groups: str, crawl: str, by: str = "") -> list[str]:
    on = f"{by}fid"
    return [
        f"""articles_to_check AS (
  SELECT * FROM (SELECT {by}fid, {_strict('furl')} AS furl, ftitle, fkeywords, fcontent,
    length(fcontent)::INT AS fcontent_len, src_type FROM {crawl}) WHERE {REPORT_ROW_OK})""",
        f"""report AS (
  SELECT {by}fid, hash, samelen, furl, ftitle, fkeywords, fcontent, fcontent_len, src_type
  FROM (SELECT {by}fid, hash, samelen FROM {groups} WHERE samelen >= 2) JOIN articles_to_check USING ({on}))""",
    ]


# Models and scores

PARENT_TRAINING = "training AS (SELECT 'all' AS model, lang AS label, token FROM content_words WHERE token IS NOT NULL)"
CHILD_TRAINING = """child_training AS (
  SELECT lang AS model, lang || '/q' || quality::VARCHAR AS label, token
  FROM content_words JOIN labels ON doc_id = fid WHERE token IS NOT NULL)"""


def _model(training: str, name: str) -> list[str]:
    return [
        f"{name}_counts AS (SELECT model, label, token, count(*) AS c FROM {training} GROUP BY ALL)",
        f"{name}_vocabulary AS (SELECT model, count(DISTINCT token) AS v FROM {name}_counts GROUP BY model)",
        f"{name}_weight AS (SELECT model, label, token, ln(c + 1) AS weight FROM {name}_counts)",
        f"{name}_known AS (SELECT DISTINCT model, token FROM {name}_counts)",
        f"""{name}_bias AS (
  SELECT model, label, -ln(sum(c) + any_value(v)) AS bias
  FROM {name}_counts JOIN {name}_vocabulary USING (model) GROUP BY model, label)""",
    ]


PARENT_MODEL = [CONTENT_WORDS, PARENT_TRAINING, *_model("training", "parent")]
CHILD_MODEL = [CONTENT_WORDS, CHILD_TRAINING, *_model("child_training", "child")]


def _score(words: str, model: str, name: str) -> list[str]:
    """``words`` is a CTE of (fid, model, token), a null token for blank texts."""
    return [
        f"""{name}_hits AS (
  SELECT fid, w.model, label, sum(weight) AS s
  FROM {words} w JOIN {model}_weight m ON m.model = w.model AND m.token = w.token GROUP BY ALL)""",
        f"""{name}_size AS (
  SELECT fid, w.model, count(w.token) AS tokens, count(k.token) AS known
  FROM {words} w LEFT JOIN {model}_known k ON k.model = w.model AND k.token = w.token GROUP BY ALL)""",
        f"""{name}_logit AS (
  SELECT n.fid, n.model, b.label, coalesce(s, 0) / known + bias AS z
  FROM {name}_size n JOIN {model}_bias b ON b.model = n.model
  LEFT JOIN {name}_hits h ON h.fid = n.fid AND h.model = n.model AND h.label = b.label WHERE known > 0)""",
        f"""{name}_power AS (
  SELECT fid, label, exp(z - max(z) OVER (PARTITION BY fid)) AS p FROM {name}_logit)""",
        f"""{name}_prob AS (
  SELECT fid, label, p / sum(p) OVER (PARTITION BY fid) AS p FROM {name}_power)""",
        f"""{name}_best AS (
  SELECT fid, label, p FROM {name}_prob
  QUALIFY row_number() OVER (PARTITION BY fid ORDER BY round(p, 6) DESC, label) = 1)""",
        f"""{name} AS (
  SELECT n.fid, n.model,
    CASE WHEN tokens = 0 THEN 'unknow' WHEN known = 0 AND n.model <> 'all' THEN n.model || '_other'
      WHEN known = 0 THEN 'unknow' ELSE b.label END AS label,
    CASE WHEN tokens = 0 THEN -1.0::DOUBLE WHEN known = 0 AND n.model <> 'all' THEN -4.0::DOUBLE
      WHEN known = 0 THEN -3.0::DOUBLE ELSE b.p END AS prob
  FROM {name}_size n LEFT JOIN {name}_best b ON b.fid = n.fid)""",
    ]


def _two_levels(words: str, side: str) -> list[str]:
    return [
        f"{side}_all AS (SELECT fid, 'all' AS model, token FROM {words})",
        *_score(f"{side}_all", "parent", f"{side}_p"),
        f"""{side}_below AS (
  SELECT fid, p.label AS model, token FROM {words} JOIN {side}_p p USING (fid)
  WHERE p.label IN ({_list(data.LISTED)}))""",
        *_score(f"{side}_below", "child", f"{side}_c"),
    ]


TITLE_LABELS = [CRAWL, TITLE_WORDS, *PARENT_MODEL, *CHILD_MODEL, *_two_levels("title_words", "title")]
CONTENT_LABELS = [*PARENT_MODEL, *CHILD_MODEL, *_two_levels("content_words", "content")]
UNION = [
    *TITLE_LABELS,
    *CONTENT_LABELS,
    """union_cat AS (
  SELECT a.fid, a.label AS title_pcat, a.prob AS title_pprob, b.label AS title_ccat, b.prob AS title_cprob,
    c.label AS content_pcat, c.prob AS content_pprob, d.label AS content_ccat, d.prob AS content_cprob
  FROM title_p a LEFT JOIN title_c b ON b.fid = a.fid LEFT JOIN content_p c ON c.fid = a.fid
  LEFT JOIN content_c d ON d.fid = a.fid)""",
]
_LABEL_COLUMNS = (
    "title_pcat, round(title_pprob, 6) AS title_pprob, title_ccat, round(title_cprob, 6) AS title_cprob, "
    "content_pcat, round(content_pprob, 6) AS content_pprob, content_ccat, round(content_cprob, 6) AS content_cprob"
)


def _assembled(crawl: str) -> list[str]:
    return [
        *UNION,
        *HASHES,
        WANTED,
        f"""assembled AS (
  SELECT a.fid, a.stat_date, {_site('a.furl')} AS furl, a.ftitle, length(a.fcontent)::INT AS fcontent_len,
    a.src_type, starts_with({_trim('a.fcontent')}, {_text(data.ERROR_PREFIX)}) AS is_error_body, b.hash,
    c.* EXCLUDE (fid)
  FROM {crawl} a LEFT JOIN hashes b ON b.fid = a.fid JOIN union_cat c ON c.fid = a.fid)""",
    ]


# Rules and decision

BLOCKED = " OR ".join(f"contains(furl, {_text(p)})" for p in data.RULES.blocked)
_TITLE_TESTS = [f"contains({_trim('ftitle')}, {_text(p)})" for p in data.JUNK_TITLES] + [
    f"regexp_matches({_trim('ftitle')}, {_text(data.CHAPTER)})"
]
JUNK_ANY, JUNK_ALL = " OR ".join(_TITLE_TESTS), " AND ".join(_TITLE_TESTS)
_HITS = " + ".join(f"contains(furl, {_text(h)})::INT" for h, _ in data.LABEL_RULES)
_FIRST = " ".join(f"WHEN contains(furl, {_text(h)}) THEN {_text(l)}" for h, l in data.LABEL_RULES)
SITE_LABEL = f"(CASE WHEN {_HITS} = 1 THEN (CASE {_FIRST} END) ELSE '' END)"
TITLE_ONLY = "(" + " OR ".join(f"contains(furl, {_text(h)})" for h in data.TITLE_ONLY) + ")"

CATEGORY = """CASE
  WHEN title_pcat IS DISTINCT FROM 'unknow' AND content_pcat IS DISTINCT FROM 'unknow' THEN CASE
    WHEN title_ccat IS NOT DISTINCT FROM content_ccat THEN title_ccat
    WHEN l <> '' AND l IS NOT DISTINCT FROM title_pcat THEN coalesce(title_ccat, l)
    WHEN l <> '' AND l IS NOT DISTINCT FROM content_pcat THEN coalesce(content_ccat, l)
    WHEN l <> '' THEN l
    WHEN o AND tpp > 0.5 THEN title_ccat
    WHEN tpp >= cpp AND tpp > 0.8 THEN coalesce(title_ccat, title_pcat)
    WHEN tpp < cpp AND cpp > 0.8 THEN coalesce(content_ccat, content_pcat)
    ELSE 'unknow' END
  WHEN title_pcat IS DISTINCT FROM 'unknow' THEN CASE
    WHEN l <> '' AND l IS NOT DISTINCT FROM title_pcat THEN coalesce(title_ccat, title_pcat)
    WHEN l <> '' THEN l
    WHEN (o AND tpp > 0.5) OR tpp > 0.8 THEN coalesce(title_ccat, title_pcat)
    ELSE 'unknow' END
  WHEN content_pcat IS DISTINCT FROM 'unknow' THEN CASE
    WHEN l <> '' AND l IS NOT DISTINCT FROM content_pcat THEN coalesce(content_ccat, content_pcat)
    WHEN l <> '' THEN l || '_unknow'
    WHEN cpp > 0.8 THEN coalesce(content_ccat, content_pcat)
    ELSE 'unknow' END
  ELSE 'unknow' END"""


def _published(where: str = "TRUE") -> list[str]:
    return [
        f"""ruled AS (
  SELECT *, {SITE_LABEL} AS l, {TITLE_ONLY} AS o, coalesce(title_pprob, 0.0) AS tpp, coalesce(content_pprob, 0.0) AS cpp
  FROM assembled WHERE {where})""",
        f"""published AS (
  SELECT stat_date, 'algo_basic' AS algo_ver, fid, ftitle, {CATEGORY} AS cat, src_type, furl,
    title_pcat, round(tpp, 6) AS title_pprob, content_pcat, round(cpp, 6) AS content_pprob FROM ruled)""",
    ]


USABLE = f"NOT ({BLOCKED}) AND NOT ({JUNK_ANY}) AND NOT is_error_body"
NOT_UNKNOWN = "WHERE cat IS DISTINCT FROM 'unknow'"

# Runs over days

DAY_EXACT = [
    CRAWL, WANTED, *HASHES,
    """day_exact AS (
  SELECT stat_date, hash, min(fid) AS fid, count(*)::BIGINT AS samelen
  FROM hashes JOIN wanted USING (fid) GROUP BY stat_date, hash)""",
]
DAY_REPORT = [*DAY_EXACT, *_near("day_exact", "stat_date, "), *_report("pass3", "crawl", "stat_date, ")]


ONE_DAY = [
    CRAWL,
    WANTED,
    *HASHES,
    "wanted_hashes AS (SELECT fid, hash FROM hashes SEMI JOIN wanted USING (fid))",
    "exact AS (SELECT hash, min(fid) AS fid, count(*)::BIGINT AS samelen FROM wanted_hashes GROUP BY hash)",
]


def _part(fid: str, per_string: int) -> str:
    return f"(('0x' || substr(md5({fid}::VARCHAR), 1, 8))::BIGINT % ceil(samelen * 2 / {per_string}.0)::BIGINT)::INT"


def _day_counts(name: str, source: str) -> str:
    return f"SELECT '{name}' AS stage, stat_date, count(*) AS n, sum(fid)::BIGINT AS sum_fid FROM {source} GROUP BY ALL"


ORACLE: dict[str, str] = {
    "crawl_day": _with(CRAWL, select="SELECT fid, stat_date, src_type, length(fcontent)::INT AS fcontent_len FROM crawl"),
    "source_whitelist": _with(CRAWL, WANTED, select="SELECT fid, src_type FROM wanted"),
    "drop_partition_col": _with(CRAWL, select="SELECT fid, furl, ftitle, fkeywords, src_type FROM crawl"),
    "sink_roundtrip": _with(
        CRAWL,
        select="SELECT stat_date, CASE WHEN stat_date >= '20240116' THEN 2 ELSE 1 END AS version, "
        "count(*) AS n, sum(fid)::BIGINT AS sum_fid FROM crawl GROUP BY ALL",
    ),
    "rule_lines": "SELECT ' ' || url AS pattern, count(*) AS n FROM pages GROUP BY ALL",
    "label_rules": _with(
        CRAWL,
        f"lines AS (SELECT fid, {_site('furl')} AS host, fkeywords AS label FROM crawl)",
        select="SELECT host, arg_max(label, fid) AS label FROM lines WHERE host <> '' AND label <> 'de' GROUP BY host",
    ),
    "debug_limit": _with(CRAWL, select="SELECT fid, furl, src_type FROM crawl ORDER BY fid LIMIT 250"),
    "site_strict": f"SELECT page_id, {_strict('url')} AS furl FROM pages",
    "site": f"SELECT page_id, {_site('url')} AS furl FROM pages",
    "content_len": "SELECT doc_id AS fid, length(text)::INT AS fcontent_len FROM documents",
    "url_blacklist": f"SELECT * FROM (SELECT page_id, {_site('url')} AS furl FROM pages) WHERE NOT ({BLOCKED})",
    "error_body": f"SELECT doc_id AS fid FROM documents WHERE NOT starts_with(text, {_text(data.ERROR_PREFIX)})",
    "junk_title": f"SELECT page_id, NOT ({JUNK_ANY}) AS intended, NOT ({JUNK_ALL}) AS as_built "
    f"FROM (SELECT page_id, {TITLE} AS ftitle FROM pages)",
    "drop_unusable": _with(
        CRAWL,
        select=f"SELECT fid, furl, ftitle FROM (SELECT fid, {_site('furl')} AS furl, ftitle, "
        f"starts_with({_trim('fcontent')}, {_text(data.ERROR_PREFIX)}) AS is_error_body FROM crawl) "
        f"WHERE {USABLE}",
    ),
    "keep_script": f"SELECT doc_id AS fid, {_letters('text')} AS kept FROM documents",
    "clean_markup": f"SELECT page_id, {_clean('html')} AS cleaned FROM pages",
    "tokenize": _with(
        CRAWL,
        select=f"SELECT fid, array_to_string({_clean_tokens('ftitle')}, ' ') AS title_words, "
        f"array_to_string({_clean_tokens('fcontent')}, ' ') AS content_words FROM crawl",
    ),
    "keywords": _with(
        LEXICON,
        f"""placed AS (
  SELECT fid, pos, t[pos] AS token FROM (
    SELECT fid, t, unnest(range(1, len(t) + 1)) AS pos
    FROM (SELECT doc_id AS fid, {_clean_tokens('text')} AS t FROM documents)))""",
        """kept AS (
  SELECT fid, string_agg(token, ',' ORDER BY pos) AS words FROM placed JOIN lexicon ON word = token
  WHERE starts_with(nature, 'n') AND length(token) >= 2 GROUP BY fid)""",
        select="SELECT doc_id AS fid, coalesce(words, '') AS words FROM documents LEFT JOIN kept ON fid = doc_id",
    ),
    "words_csv": f"SELECT doc_id AS fid, array_to_string({_hash_tokens('text')}, ',') AS words FROM documents",
    "fnv1a64": _with(
        CONTENT_WORDS,
        "word AS (SELECT DISTINCT token FROM content_words WHERE token IS NOT NULL)",
        f"fnv AS (SELECT token, {FNV_64.format('token')} AS u FROM word)",
        select=f"SELECT token, {_signed('u')} AS hash FROM fnv",
    ),
    "simhash": _with(*HASHES, select="SELECT fid, hash FROM hashes"),
    "simhash_fnv": _with(HASH_WORDS, *_hash_ctes(FNV_64, "hash_words"), select="SELECT fid, hash FROM hashes"),
    "simhash_keywords": _with(
        CONTENT_WORDS,
        LEXICON,
        "lexical AS (SELECT fid, token FROM content_words JOIN lexicon ON word = token "
        "WHERE starts_with(nature, 'n') AND length(token) >= 2)",
        *_hash_ctes(MD5_64, "lexical"),
        select="SELECT doc_id AS fid, coalesce(hash, 0) AS hash FROM documents LEFT JOIN hashes ON fid = doc_id",
    ),
    "exact_groups": _with(*EXACT, select="SELECT hash, fid, samelen FROM exact"),
    "exact_members": _with(
        *EXACT,
        select="SELECT hash, e.fid AS leader, samelen, h.fid FROM hashes h JOIN exact e USING (hash)",
    ),
    "members_csv": _with(
        *EXACT,
        select=f"SELECT e.fid AS leader, samelen, {_part('h.fid', 4)} AS part, "
        "string_agg(h.fid::VARCHAR, ',' ORDER BY h.fid) AS samefid FROM hashes h JOIN exact e USING (hash) GROUP BY ALL",
    ),
    "mask_block": _with(
        *HASHES,
        select="SELECT fid, "
        + ", ".join(f"hash & ({signed64(m)})::BIGINT AS block{b}" for b, m in enumerate(fixed.BLOCK_MASKS))
        + " FROM hashes",
    ),
    "near_pairs": _with(
        *EXACT,
        "paired AS ("
        + " UNION ".join(
            "SELECT a.fid AS fid_a, b.fid AS fid_b, a.hash AS hash_a, b.hash AS hash_b FROM exact a JOIN exact b "
            f"ON a.hash & ({signed64(m)})::BIGINT = b.hash & ({signed64(m)})::BIGINT AND a.fid < b.fid "
            "WHERE bit_count(xor(a.hash, b.hash)) <= 1"
            for m in fixed.BLOCK_MASKS
        )
        + ")",
        select="SELECT * FROM paired",
    ),
    "near_pairs_k3": _with(
        *EXACT,
        select="SELECT a.fid AS fid_a, b.fid AS fid_b, a.hash AS hash_a, b.hash AS hash_b FROM exact a JOIN exact b "
        "ON a.fid < b.fid WHERE bit_count(xor(a.hash, b.hash)) <= 3",
    ),
    "group_top": _with(
        *EXACT,
        f"masked_hash AS (SELECT hash & ({signed64(fixed.BLOCK_MASKS[3])})::BIGINT AS masked, * FROM exact)",
        select="SELECT masked, fid, hash, samelen FROM masked_hash "
        "QUALIFY row_number() OVER (PARTITION BY masked ORDER BY samelen DESC, fid) = 1",
    ),
    "absorb_block": _with(
        *EXACT,
        "start AS (SELECT hash, fid, samelen, [hash] AS hashes FROM exact)",
        *[cte for b in range(4) for cte in _absorb("start", b, f"alone{b}")],
        select=" UNION ALL ".join(f"SELECT {SHOWN}, {b} AS block FROM alone{b}" for b in range(4)),
    ),
    "near_groups": _with(*EXACT, *_near(), select=f"SELECT {SHOWN} FROM pass3"),
    "near_groups_check": "SELECT count(*) AS samelen, count(*) AS members, 0::BIGINT AS near_leaders FROM documents",
    "near_members": _with(
        *EXACT,
        *_near(),
        "led AS (SELECT fid AS leader, samelen, unnest(hashes) AS hash FROM pass3)",
        select="SELECT leader, samelen, fid FROM hashes JOIN led USING (hash)",
    ),
    "dup_report": _with(CRAWL, *EXACT, *_near(), *_report("pass3", "crawl"), select="SELECT * FROM report"),
    "score_parent": _with(
        *PARENT_MODEL,
        "content_all AS (SELECT fid, 'all' AS model, token FROM content_words)",
        *_score("content_all", "parent", "content_p"),
        select="SELECT fid, label, round(prob, 6) AS prob FROM content_p",
    ),
    "score_label_only": _with(
        *PARENT_MODEL,
        "content_all AS (SELECT fid, 'all' AS model, token FROM content_words)",
        *_score("content_all", "parent", "content_p"),
        select="SELECT fid, label FROM content_p",
    ),
    "score_codes": _with(
        CRAWL,
        *CHILD_MODEL,
        PARENT_TRAINING,
        *_model("training", "parent"),
        LEXICON,
        f"""titles AS (SELECT fid, fkeywords, {_clean_tokens('ftitle')} AS t FROM crawl)""",
        """asked AS (
  SELECT fid, CASE fkeywords WHEN 'en' THEN 'de' WHEN 'de' THEN 'fr' WHEN 'fr' THEN 'none' ELSE 'all' END AS model, t FROM titles
  UNION ALL
  SELECT -1 - fid, 'all', list_filter(t, lambda w: length(w) >= 2 AND list_contains(v, w))
  FROM titles, (SELECT list(word) AS v FROM lexicon WHERE starts_with(nature, 'v')))""",
        "asked_words AS (SELECT fid, model, unnest(CASE WHEN len(t) = 0 THEN [NULL] ELSE t END) AS token FROM asked)",
        *[f"both_{x} AS (SELECT * FROM parent_{x} UNION ALL SELECT * FROM child_{x})" for x in ("weight", "known", "bias")],
        *_score("asked_words", "both", "scored"),
        select="SELECT fid, model, label, round(prob, 6) AS prob FROM scored",
    ),
    "score_plugin": "SELECT doc_id AS fid, CASE WHEN doc_id % 50 < 2 OR length(text) < 400 OR length(text) > 5000 "
    "THEN 'unknow' WHEN length(text) > 2000 THEN 'long' ELSE 'short' END AS label, CASE WHEN doc_id % 50 < 2 "
    "THEN -1.0::DOUBLE WHEN length(text) < 400 THEN -255.0::DOUBLE WHEN length(text) > 5000 THEN -3.0::DOUBLE "
    "ELSE round(1.0::DOUBLE / length(text), 9) END AS prob FROM documents",
    "parent_labels": _with(
        *PARENT_MODEL,
        "content_all AS (SELECT fid, 'all' AS model, token FROM content_words)",
        *_score("content_all", "parent", "content_p"),
        select=f"SELECT fid, array_to_string({_clean_tokens('text')}, ' ') AS words, label AS cat, "
        "round(prob, 6) AS prob FROM content_p JOIN documents ON doc_id = fid",
    ),
    "child_labels": _with(
        *CONTENT_LABELS, select="SELECT fid, label AS cat, round(prob, 6) AS prob FROM content_c"
    ),
    "union_all_labels": _with(
        *TITLE_LABELS,
        *CONTENT_LABELS,
        select="SELECT fid, label AS cat, round(prob, 6) AS prob FROM title_c UNION ALL "
        "SELECT fid, label, round(prob, 6) FROM content_c",
    ),
    "assemble_labels": _with(*UNION, select=f"SELECT fid, {_LABEL_COLUMNS} FROM union_cat"),
    "assemble_articles": _with(
        *_assembled("wanted"),
        select="SELECT fid, furl, ftitle, fcontent_len, src_type, is_error_body, hash, "
        f"{_LABEL_COLUMNS} FROM assembled",
    ),
    "site_label": f"SELECT page_id, {SITE_LABEL} AS site_label "
    f"FROM (SELECT page_id, {_site('url')} AS furl FROM pages)",
    "title_only_site": f"SELECT page_id, {TITLE_ONLY} AS is_title_only "
    f"FROM (SELECT page_id, {_site('url')} AS furl FROM pages)",
    "url_table": _with(
        HOST_RULES,
        select="SELECT page_id FROM pages WHERE NOT EXISTS "
        f"(FROM host_rules WHERE label = '{data.BLOCKED_LANG}' AND contains(url, host))",
    ),
    "site_label_table": _with(
        HOST_RULES,
        select="SELECT page_id, CASE WHEN count(host) = 1 THEN min(label) ELSE '' END AS site_label "
        "FROM pages LEFT JOIN host_rules ON contains(url, host) GROUP BY page_id",
    ),
    "title_only_table": _with(
        HOST_RULES,
        select=f"SELECT page_id, count(host) > 0 AS is_title_only FROM pages LEFT JOIN host_rules "
        f"ON label = '{data.TITLE_LANG}' AND contains(url, host) GROUP BY page_id",
    ),
    "repeated_ids_keywords": _with(
        CRAWL,
        LEXICON,
        # Second rows have ids of their own here.
        f"""both_rows AS (
  SELECT doc_id AS fid, {_clean_tokens('text')} AS t FROM documents SEMI JOIN crawl ON fid = doc_id
  UNION ALL SELECT -1 - fid, {_clean_tokens('ftitle')} FROM crawl WHERE fid % 3 = 0)""",
        "both_placed AS (SELECT fid, pos, t[pos] AS token FROM (SELECT fid, t, unnest(range(1, len(t) + 1)) AS pos FROM both_rows))",
        "both_kept AS (SELECT fid, pos, token FROM both_placed JOIN lexicon ON word = token "
        "WHERE starts_with(nature, 'n') AND length(token) >= 2)",
        *_hash_ctes(MD5_64, "both_kept"),
        "both_words AS (SELECT fid, string_agg(token, ' ' ORDER BY pos) AS value FROM both_kept GROUP BY fid)",
        select="SELECT CASE WHEN fid < 0 THEN -1 - fid ELSE fid END AS fid, value FROM ("
        "SELECT fid, coalesce(value, '') AS value FROM both_rows LEFT JOIN both_words USING (fid) "
        "UNION ALL SELECT fid, coalesce(hash, 0)::VARCHAR FROM both_rows LEFT JOIN hashes USING (fid))",
    ),
    "final_label": _with(
        *_assembled("crawl"), *_published(), select=f"SELECT * EXCLUDE (stat_date) FROM published {NOT_UNKNOWN}"
    ),
    "article_labels_run": _with(
        *_assembled("wanted"),
        *_published(USABLE),
        select=f"SELECT * EXCLUDE (stat_date) FROM published {NOT_UNKNOWN}",
    ),
    "duplicate_run": _with(
        *DAY_REPORT,
        select="SELECT stat_date, fid, hash, samelen, furl, ftitle, fcontent_len, src_type FROM report",
    ),
    "duplicate_run_none": _with(
        *DAY_REPORT,
        select="SELECT stat_date, fid, hash, samelen, furl, ftitle, fcontent_len, src_type FROM report WHERE samelen >= 10",
    ),
    "duplicate_run_day": _with(
        *ONE_DAY, *_near(), *_report("pass3", "crawl"),
        select=f"SELECT '{data.FIRST_DAY}' AS stat_date, fid, hash, samelen, furl, ftitle, fcontent_len, src_type FROM report",
    ),
    "run_near_members": _with(
        *ONE_DAY, *_near(),
        "led AS (SELECT fid AS leader, samelen, unnest(hashes) AS hash FROM pass3)",
        select=f"SELECT leader, samelen, {_part('h.fid', fixed.MEMBERS_PER_STRING)} AS part, "
        "string_agg(h.fid::VARCHAR, ',' ORDER BY h.fid) AS samefid FROM wanted_hashes h JOIN led USING (hash) GROUP BY ALL",
    ),
    "sink_empty_day": _with(
        CRAWL,
        select="SELECT stat_date, count(*) AS n, sum(fid)::BIGINT AS sum_fid FROM crawl "
        "WHERE stat_date >= '20240111' OR (fid % 2 = 0 AND stat_date <> '20240105') GROUP BY ALL",
    ),
    "repeated_ids": _with(
        CRAWL,
        *PARENT_MODEL,
        TITLE_WORDS,
        # Second rows have ids of their own here.
        """twice AS (
  SELECT fid, token FROM content_words SEMI JOIN crawl USING (fid)
  UNION ALL SELECT -1 - fid, token FROM title_words WHERE fid % 3 = 0)""",
        *_hash_ctes(MD5_64, "twice"),
        "twice_all AS (SELECT fid, 'all' AS model, token FROM twice)",
        *_score("twice_all", "parent", "scored"),
        select="SELECT CASE WHEN fid < 0 THEN -1 - fid ELSE fid END AS fid, value FROM "
        "(SELECT fid, hash::VARCHAR AS value FROM hashes UNION ALL SELECT fid, label FROM scored)",
    ),
    "run_union_cat": _with(*UNION, WANTED, select=f"SELECT stat_date, fid, {_LABEL_COLUMNS} FROM union_cat JOIN wanted USING (fid)"),
    "run_etl": _with(*_assembled("wanted"), *_published(USABLE), select=f"SELECT * FROM published {NOT_UNKNOWN}"),
    "label_run_plugin": _with(
        CRAWL,
        WANTED,
        *[
            f"""{side} AS (
  SELECT fid, stat_date, len(w), CASE WHEN w = '' THEN 'unknow' ELSE ['de', 'en', 'fr', 'es'][length(split_part(w, ' ', 1)) % 4 + 1] END AS pcat,
    CASE WHEN w = '' THEN -1.0::DOUBLE ELSE 0.75::DOUBLE END AS pprob, w
  FROM (SELECT fid, stat_date, array_to_string({_clean_tokens(column)}, ' ') AS w FROM wanted))"""
            for side, column in (("title", "ftitle"), ("content", "fcontent"))
        ],
        select="SELECT t.stat_date, t.fid, "
        + ", ".join(
            f"{x}.pcat AS {side}_pcat, {x}.pprob AS {side}_pprob, CASE WHEN {x}.pcat = 'fr' THEN 'fr_other' "
            f"WHEN {x}.pcat IN ({_list(data.LISTED)}) THEN {x}.pcat || CASE WHEN length({x}.w) > 1000 THEN '/long' ELSE '/short' END END "
            f"AS {side}_ccat, CASE WHEN {x}.pcat = 'fr' THEN -4.0::DOUBLE WHEN {x}.pcat IN ({_list(data.LISTED)}) THEN 0.25::DOUBLE END "
            f"AS {side}_cprob"
            for x, side in (("t", "title"), ("c", "content"))
        )
        + " FROM title t JOIN content c USING (fid)",
    ),
    "label_range": _with(
        *_assembled("wanted"),
        *_published(USABLE),
        *DAY_REPORT,
        "day_hashes AS (SELECT * FROM hashes JOIN wanted USING (fid))",
        "day_union AS (SELECT * FROM union_cat JOIN wanted USING (fid))",
        f"day_published AS (SELECT * FROM published {NOT_UNKNOWN})",
        select=" UNION ALL ".join(
            [
                _day_counts("simhash_hash", "day_hashes"),
                _day_counts("simhash_dup_threshold_10", "report"),
                _day_counts("union_cat", "day_union"),
                _day_counts("etl", "day_published"),
            ]
        ),
    ),
}
