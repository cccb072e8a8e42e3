"""The SQL each registered query is checked against.

The statements take other routes than the Spark plans where they can: windows over lines and mentions
where Spark works inside a row, joins where Spark uses arrays, and patterns without look-around.
"""

from __future__ import annotations

from chronolink.functions.markup import IGNORED_TAGS
from chronolink.operators.date_words import MONTHS, SHAPES, TOKEN, date_words
from chronolink.operators.tokens import LEADING, TRAILING
from chronolink.plans.corpus import CORPUS_SQL

NL = "chr(10)"
CORPUS = f"corpus AS ({CORPUS_SQL})"
ARTICLE_PAGES = "pg AS (SELECT * FROM corpus WHERE ns = 0 AND redirect_to IS NULL)"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rx(expr: str, *rules: tuple[str, str]) -> str:
    """Apply regular expressions one after the other, every match."""
    for pattern, replacement in rules:
        expr = f"regexp_replace({expr}, {quoted(pattern)}, {quoted(replacement)}, 'g')"
    return expr


TEMPLATE = (r"\{\{[^{}]*\}\}", "")
TABLE = (r"\{\|[^{}]*\|\}", "")
BOLD = (r"'''([^'\n]*)'''", r"\1")
ITALIC = (r"''([^'\n]*)''", r'"\1"')
FOREIGN = (r"\[\[[^\[\]|:]+:[^\[\]]*\]\]", "")
PIPED = (r"\[\[([^\[\]|]*)\|([^\[\]|]*)\]\]", r'<a href="\1">\2</a>')
PLAIN = (r"\[\[([^\[\]|]*)\]\]", r'<a href="\1">\1</a>')
EXTERNAL = (r"\[http://[^\]]*\]", "")
HTML = ((r"<!--[^>]*-->", ""), (r"<br/>", ""), (r"</?b>", ""), (r"<ref>[^<]*</ref>", ""))


def _dated(lang: str, sentence: str) -> str:
    """A sentence with places for day, month, year, century, early year and decade of a document, as an expression."""
    names = MONTHS[lang].title() if lang in ("en", "de") else MONTHS[lang]
    parts = {
        "D": "CAST(doc_id % 28 + 1 AS STRING)", "M": f"split_part('{names}', ' ', CAST(doc_id % 12 AS INT) + 1)",
        "Y": "CAST(1600 + doc_id % 400 AS STRING)", "C": "CAST(doc_id % 17 + 4 AS STRING)",
        "N": "CAST(doc_id % 700 + 1 AS STRING)", "T": "CAST(170 + doc_id % 30 AS STRING) || '0'",
    }
    pieces = sentence.split("~")
    return " || ".join(parts[p] if i % 2 else quoted(p) for i, p in enumerate(pieces))


# Whole texts with dates in their language behind them.
DATED_TEXT = f"""coalesce(text, '') || ' ' || CASE lang
    WHEN 'en' THEN {_dated('en', 'On ~D~ ~M~ ~Y~, ~M~ ~D~, ~Y~ or the 2nd of ~M~ ~Y~; ~M~, ~Y~ in the ~C~th century, ~N~ BC, not the ~T~s. May 3.')}
    WHEN 'de' THEN {_dated('de', 'Am ~D~. ~M~ ~Y~, im ~M~ ~Y~, im ~C~. Jahrhundert, ~N~ v. Chr. und die ~T~er: 1234er Mai.')}
    WHEN 'fr' THEN {_dated('fr', 'Le ~D~ ~M~ ~Y~, le 1er ~M~ ~Y~, en ~M~ ~Y~ au ~C~e siècle, en ~N~ av. J.-C. et en 99.')}
    WHEN 'es' THEN {_dated('es', 'El ~D~ de ~M~ de ~Y~, en ~M~ de ~Y~ del siglo ~C~, ~N~ a. C. y 32 de ~M~.')}
    ELSE {_dated('en', '~D~ ~M~ ~Y~')} END"""


def articles(keep_sections: bool = False, keep_lists: bool = True) -> str:
    """CTEs from ``pg`` to ``art``: cleaned articles, lines handled one by one."""
    dropped = ("'none'", *(["'head'"] * (not keep_sections)), *(["'bullet'", "'number'"] * (not keep_lists)))
    markup = rx(
        "wikitext", TEMPLATE, TEMPLATE, TEMPLATE, TABLE, BOLD, ITALIC, FOREIGN, PIPED, PLAIN,
        EXTERNAL, ("__NOTOC__", ""), *HTML,
    )
    markup = f"replace(replace({markup}, '&nbsp;', chr(160)), '&lt;', '<')"
    markup = rx(
        markup, (r"<math>[^<]*</math>", "formula_1"), (" +", " "), (r"\n[^\p{L}\p{N}_]+?\n", "\n")
    ).replace("'\n'", NL)
    head = (
        "regexp_matches(line, '^==')",
        r"'Section::::' || regexp_extract(line, '^=+ *(.*?) *=+', 1) || '.'",
    )
    return f"""
mk AS (SELECT page_id, rev_id, title, {markup} AS t FROM pg),
ln AS (SELECT page_id, rev_id, title, unnest(string_split(t, {NL})) AS line,
              generate_subscripts(string_split(t, {NL}), 1) AS n FROM mk),
kd AS (SELECT *, CASE WHEN line LIKE '#%' THEN 'number' WHEN line LIKE '*%' THEN 'bullet'
                      WHEN {head[0]} THEN 'head' WHEN line = '' THEN 'blank' ELSE 'text' END AS kind FROM ln),
ch AS (SELECT *, CASE WHEN kind IS DISTINCT FROM lag(kind) OVER (PARTITION BY page_id ORDER BY n) THEN 1 ELSE 0 END AS c FROM kd),
ru AS (SELECT *, sum(c) OVER (PARTITION BY page_id ORDER BY n) AS run FROM ch),
it AS (SELECT page_id, rev_id, title, n, kind, CASE kind
         WHEN 'number' THEN 'BULLET::::' || row_number() OVER (PARTITION BY page_id, run ORDER BY n) || '. ' || trim(substr(line, 2))
         WHEN 'bullet' THEN 'BULLET::::- ' || trim(substr(line, 2))
         WHEN 'head' THEN {head[1]} ELSE line END AS line
       FROM ru WHERE kind NOT IN ({", ".join(dropped)})),
bl AS (SELECT *, lag(line) OVER (PARTITION BY page_id ORDER BY n) AS before,
              max(CASE WHEN line <> '' THEN n END) OVER (PARTITION BY page_id) AS last_n FROM it),
kept AS (SELECT * FROM bl WHERE n <= last_n AND (line <> '' OR before <> '')),
art AS (SELECT page_id, rev_id, title, string_agg(line, {NL} ORDER BY n) AS text FROM kept GROUP BY ALL)"""


PROSE = rf"regexp_replace(text || {NL}, 'BULLET::::([^\n]*)\n', '\1.' || {NL}, 'g')"
SPLIT = "chr(1)"


def split_sentences(source: str, text: str, name: str = "sen") -> str:
    """CTE of kept sentences, numbered from 0."""
    marked = rf"regexp_replace({text}, '([.:;?!])[\n "
    marked += rf""""]', '\1' || {SPLIT}, 'g')"""
    marked = f"replace(replace({marked}, 'BULLET::::', {SPLIT}), {NL}, {SPLIT})"
    return f"""
{name}_raw AS (SELECT page_id, unnest(string_split({marked}, {SPLIT})) AS sentence,
                      generate_subscripts(string_split({marked}, {SPLIT}), 1) AS n FROM {source}),
{name} AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS INT) AS sid, sentence
           FROM {name}_raw WHERE length(sentence) > 3)"""


DATES = (
    r"\b\d{4} – \d{4}\b|\b\d{4}-\d{2}-\d{2}\b|\b\d{1,2}th century\b|\b\d{1,4} BC\b|\b\d{1,4} AD\b"
    r"|\b\d{3}0s\b|\b\d{4}\b"
)
ANCHOR = r'<a href="[^"]*">[^<]*</a>'

VALUE = r"""CASE
  WHEN m LIKE '%–%' THEN '[' || left(m, 4) || ',' || right(m, 4) || ']'
  WHEN m LIKE '%century' THEN lpad(CAST(CAST(regexp_extract(m, '\d+') AS INT) - 1 AS VARCHAR), 2, '0')
  WHEN m LIKE '%BC' THEN 'BC' || lpad(regexp_extract(m, '\d+'), 4, '0')
  WHEN m LIKE '%AD' THEN lpad(regexp_extract(m, '\d+'), 4, '0')
  WHEN m LIKE '%s' THEN left(m, 3)
  ELSE m END"""
USABLE = """CASE WHEN value LIKE '[%' THEN value WHEN length(value) = 3 THEN 'DECADE ' || value
  WHEN length(value) = 2 THEN 'CENTURY ' || value WHEN value LIKE 'BC%' THEN value ELSE left(value, 4) END"""


def mentions(sentences: str = "sen") -> str:
    """CTE of links and dates in text order."""
    hits = f"regexp_extract_all(sentence, {quoted(ANCHOR + '|' + DATES)})"
    return f"""
hit AS (SELECT page_id, sid, sentence, unnest({hits}) AS m, CAST(generate_subscripts({hits}, 1) - 1 AS INT) AS pos FROM {sentences}),
men AS (SELECT page_id, sid, sentence, pos, m, m LIKE '<a %' AS is_link,
               regexp_extract(m, '<a href="([^"]*)"', 1) AS link, {VALUE} AS value FROM hit)"""


PAIRS = f"""
grp AS (SELECT *, count(*) FILTER (WHERE is_link) OVER (PARTITION BY page_id, sid ORDER BY pos) AS link_ord,
               last_value(CASE WHEN is_link THEN link END IGNORE NULLS) OVER (PARTITION BY page_id, sid ORDER BY pos
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS title FROM men),
pairs AS (SELECT page_id, sid, CAST(link_ord AS INT) AS link_ord, title AS link,
                 string_agg({USABLE}, ',' ORDER BY pos) AS dates,
                 regexp_replace(any_value(sentence), '<[^>]*>', '', 'g') AS sentence
          FROM grp WHERE NOT is_link AND link_ord > 0 GROUP BY page_id, sid, link_ord, title)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def pages_with(text: str) -> str:
    """Article pages with another text."""
    return f"pg AS (SELECT page_id, rev_id, title, ns, redirect_to, {text} AS wikitext FROM corpus WHERE ns = 0 AND redirect_to IS NULL)"


BASE = (CORPUS, ARTICLE_PAGES)
FULL = (*BASE, articles())
SENTENCES = (*FULL, split_sentences("art", PROSE))
PAIRED = (*SENTENCES, mentions(), PAIRS)

# --- derived inputs, written so that both engines run them -----------------------------------------
LINK_TEXT = (
    "wikitext || chr(10) || '[[File:b.png|thumb|see [[' || title || ']] now]] [[w:Foo bar|foo]]s "
    "[[:Category:Bar|bar]] [[' || title || '#top|x|the  top ]]'"
)
TIMES_TEXT = (
    "wikitext || chr(10) || 'It took 3 weeks and 12 days, every Monday at 10:30, twice a year or for 20 minutes, until ' || "
    "CAST(1950 + page_id % 50 AS STRING) || ' in [[Old Town]].'"
)
PLACEHOLDER_TEXT = (
    "wikitext || '<math>' || title || '</math> <math>x+1</math><code>a</code> <math>' || title || '</math>'"
)
NORMALIZE_TEXT = (
    "wikitext || chr(10) || chr(9) || title || '  B.....C <<x>>,,y,.z' || chr(10) || '***' || chr(10) || 'end'"
)
TABLE_TEXT = "'! style=\"width:50%;\" | head' || chr(10) || wikitext"
HEADING_TEXT = (
    "wikitext || chr(10) || '=== Sub ' || title || ' ===' || chr(10) || 'x' || chr(10) || '== Empty ==' || chr(10)"
    " || '==Last?==' || chr(10) || CASE WHEN page_id % 2 = 0 THEN '=== Deep ===' || chr(10) ELSE '' END"
    " || CASE WHEN page_id % 3 = 0 THEN 'tail' ELSE '' END"
)
LIST_TEXT = (
    "wikitext || chr(10) || '# one' || chr(10) || '## one a' || chr(10) || '## one ' || title || chr(10)"
    " || '# two' || chr(10) || '#* dot' || chr(10) || '## again' || chr(10) || '* star' || chr(10) || '# restart'"
)
STACKED_TEXT = (
    "wikitext || chr(10) || 'In [[First ' || title || ']] the [[Sales of ' || CAST(1900 + page_id % 100 AS STRING) || '|sales of '"
    " || CAST(1800 + page_id % 90 AS STRING) || ']] and [[Total|in 1950]] of 1960.'"
)
CODE_TEXT = (
    "wikitext || chr(10) || 'code ' || title || '<b>x</b> <syntaxhighlight lang=\"sql\">SELECT <b>' || title"
    " || '</b> &lt; 1</syntaxhighlight> end &lt;'"
)
NOWIKI_TEXT = "'{{a|' || title || '}}<nowiki>{{x|' || title || '}}</nowiki> {{y}}' || wikitext"
ENCODED_TEXT = "wikitext || 'see [[' || title || '/a*b~c é|label]] or [[Plain]]'"
CALL_TEXT = (
    "wikitext || ' {{ quote box |a||[[X|y]] |2= B |k = v=w|k=last}} {{#if:x|y}} {{lc:ABC}} {{:Main ' || title || '}}'"
)
RULE_LINES = (
    "CASE WHEN c_custkey % 4 = 0 THEN '# ' || c_name WHEN c_custkey % 4 = 1 THEN '^' || c_name"
    " WHEN c_custkey % 4 = 2 THEN '  ' || c_name || ' ' ELSE '' END"
)
DATE_VALUES = (
    "CASE o_orderkey % 14 WHEN 0 THEN y WHEN 1 THEN y || '-05' WHEN 2 THEN y || '-05-12' WHEN 3 THEN y || '-SP'"
    " WHEN 4 THEN 'BC' || y WHEN 5 THEN y || '5' WHEN 6 THEN 'XXXX-05' WHEN 7 THEN left(y, 3)"
    " WHEN 8 THEN 'BC' || left(y, 2) WHEN 9 THEN left(y, 2) WHEN 10 THEN '[' || y || ',2001]'"
    " WHEN 11 THEN '[' || y || '-01-02,1995]' WHEN 12 THEN '[' || left(y, 3) || ',200]' ELSE 'PRESENT_REF' END"
)
TITLES = (
    "CASE p_partkey % 5 WHEN 0 THEN ' _' || p_name || '__x  y_ ' WHEN 1 THEN 'template:  ' || p_name"
    " WHEN 2 THEN lower(p_brand) || ':' || p_name WHEN 3 THEN lower(p_brand) || ':   ' || p_name ELSE ':' || p_name END"
)
PART_TITLES = (
    "CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_type || ':' || p_name"
    " WHEN 2 THEN p_brand || ':' || p_name || '/' || p_type || '/' || p_size ELSE p_name || '/' || p_type END"
)
# templates that call templates: two smaller ones, some through redirects, and circles among the first
TEMPLATE_PAGES = """
SELECT p_partkey * 2 AS page_id, 1 AS rev_id, 'Template:Part ' || p_partkey AS title, 10 AS ns, CAST(NULL AS STRING) AS redirect_to,
  '<noinclude>{{Manual}}</noinclude>' || p_name || ' {{Part ' || CAST(floor(p_partkey / 2) AS INT) || '|x={{{1|{{{2}}}}}}}} {{part '
    || CAST(floor(p_partkey / 3) AS INT) || '|{{Part 4}}}}' || CASE WHEN p_partkey % 4 = 0 THEN ' {{Alias ' || CAST(floor(p_partkey / 8) AS INT) || '}}' ELSE '' END
    || CASE WHEN p_partkey < 8 THEN '{{Part ' || (p_partkey + 3) || '}}' ELSE '' END AS wikitext
FROM part
UNION ALL
SELECT p_partkey * 2 + 1, 1, 'Template:Alias ' || p_partkey, 10, 'Template', '#REDIRECT [[Template:'
  || CASE WHEN p_partkey % 5 = 0 THEN 'Alias ' || (p_partkey + 1) WHEN p_partkey % 7 = 0 THEN 'Alias ' || p_partkey ELSE 'Part ' || p_partkey END || ']]'
FROM part
"""
PART_CALLS = "'{{Part ' || l_partkey || '}} and {{Alias ' || l_suppkey || '|' || l_linestatus || '}}'"
CLITIC_TEXT = "replace(replace(replace(text, ' the ', '''s the '), ' la ', '-la '), ' de ', ' l''')"
DUPLICATED = """SELECT * FROM corpus UNION ALL
  SELECT page_id, rev_id + 1, title, ns, redirect_to, wikitext FROM corpus WHERE page_id % 7 = 0"""
OLD_PAGES = """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN rev_id - 1 ELSE rev_id END AS rev_id
  FROM corpus WHERE page_id % 5 <> 0"""
CATEGORY_RULES = (("BUILDING", "include"), ("FURNITURE", "include"), ("NATION_15 in 1998", "exclude"))


def step(expr: str, text: str = "wikitext", columns: str = "page_id") -> str:
    """A query over article pages that shows one cleaning step."""
    return f"{with_(*BASE)} SELECT {columns}, {expr} AS text FROM (SELECT page_id, title, {text} AS wikitext FROM pg)"


# --- tokens -----------------------------------------------------------------------------------------
def _class(chars: str) -> str:
    return "[" + "".join("\\" + c if c in "[]\\^-" else c for c in chars) + "]"


LEAD, TRAIL = _class(LEADING), _class(TRAILING)


def words(text: str = "text") -> str:
    spaced = rx(
        f"' ' || replace(replace({text}, {NL}, ' '), chr(9), ' ') || ' '",
        (r"\.\.\.", " ... "), (r"([;!?])([^ ])", r"\1 \2"), (r"([.,:])([^ 0-9.])", r"\1 \2"),
    )
    return f"""
wd AS (SELECT lang, w, count(*) AS n FROM (SELECT lang, unnest(string_split_regex({spaced}, '\\s+')) AS w FROM documents)
       WHERE w <> '' GROUP BY ALL),
w1 AS (SELECT *, regexp_extract(w, {quoted(f'^({LEAD}*)(.+)$')}, 1) AS lead,
                 regexp_extract(w, {quoted(f'^({LEAD}*)(.+)$')}, 2) AS rest FROM wd),
w2 AS (SELECT *, regexp_extract(rest, {quoted(rf'^(.+?)((?:{TRAIL}\.?)*)$')}, 1) AS core,
                 regexp_extract(rest, {quoted(rf'^(.+?)((?:{TRAIL}\.?)*)$')}, 2) AS trail FROM w1),
w3 AS (SELECT *, core LIKE '_%.' AND core <> '...' AND NOT regexp_full_match(core, '([A-Za-z-]\\.)+')
                 AND NOT (lang = 'de' AND regexp_full_match(core, '[0-9]+\\.')) AS stops FROM w2),
w4 AS (SELECT *, CASE WHEN stops THEN left(core, length(core) - 1) ELSE core END AS stem FROM w3)"""


# Clitics of a stem, for the languages that occur here.
CLITICS = r"""
w5 AS (SELECT *, CASE WHEN lang = 'fr' THEN regexp_extract(stem, '^((?:(?:[dcjlmnstDCJLNMST]|[QqJj]us?qu|[Qq]u|[Ll]orsqu)'')*)(.+)$', 1) ELSE '' END AS pre FROM w4),
w6 AS (SELECT *, substr(stem, length(pre) + 1) AS mid FROM w5),
w7 AS (SELECT *, CASE lang
    WHEN 'en' THEN regexp_extract(mid, '^.+?((?:''(?:s|re|ve|d|m|em|ll)|n''t)*)$', 1)
    WHEN 'fr' THEN regexp_extract(mid, '^.+?((?:-t-elles?|-t-ils?|-t-on|-ce|-elles?|-ils?|-je|-la|-les?|-leur|-lui|-mmes?|-m''|-moi|-nous|-on|-toi|-tu|-t''|-vous|-en|-y|-ci|-l)*)$', 1)
    ELSE '' END AS post FROM w6),
w8 AS (SELECT *, list_concat(
    list_filter(regexp_extract_all(pre, '[^'']+'''), lambda x: x <> ''),
    [left(mid, length(mid) - length(post))],
    CASE WHEN lang = 'en' THEN regexp_extract_all(post, '''(?:s|re|ve|d|m|em|ll)|n''t') ELSE regexp_extract_all(post, '-(?:t-)?[a-z'']+') END) AS parts FROM w7)"""

TOKENS = """
tk AS (SELECT lang, n, unnest(list_concat(string_split(lead, ''), {body}, string_split(trail, ''))) AS token FROM w8 {join}),
tc AS (SELECT lang, token, CAST(sum(n) AS BIGINT) AS n FROM tk WHERE token <> '' GROUP BY ALL)"""

ABBREVIATIONS = r"SELECT DISTINCT regexp_extract(text, '(?:^|\s)(\p{L}{2,3})\.', 1) AS word FROM documents"

PHRASES = """SELECT DISTINCT p AS phrase FROM (
    SELECT unnest([w[1] || ' ' || w[2], w[1] || ' ' || w[2] || ' ' || w[3], w[2] || ' ' || w[3] || ' ' || w[4], w[3] || ' ' || w[4],
      array_to_string(w[2:6], ' '), array_to_string(w[1:6], ' ')]) AS p
    FROM (SELECT string_split(replace(text, chr(10), ' '), ' ') AS w FROM benchmark WHERE len(string_split(replace(text, chr(10), ' '), ' ')) >= 4))
  WHERE p IS NOT NULL"""


def phrase_ctes() -> str:
    spaced = rx(
        f"' ' || replace(replace(text, {NL}, ' '), chr(9), ' ') || ' '",
        (r"\.\.\.", " ... "), (r"([;!?])([^ ])", r"\1 \2"), (r"([.,:])([^ 0-9.])", r"\1 \2"),
    )
    toks = f"list_filter(string_split_regex({spaced}, '\\s+'), lambda x: x <> '')"
    ucf = "upper(left(lower({0}), 1)) || substr(lower({0}), 2)"
    fit = "({0} IN ({1}, lower({1}), " + ucf.format("{1}") + "))"
    return f"""
ph AS ({PHRASES}),
pw AS (SELECT phrase, list_filter(string_split(phrase, ' '), lambda x: x <> '') AS p FROM ph),
pl AS (SELECT DISTINCT p, len(p) AS k, array_to_string(p, ' ') AS phrase FROM pw WHERE len(p) > 1),
tx AS (SELECT doc_id, {toks} AS t FROM documents),
ps AS (SELECT doc_id, t, unnest(range(1, len(t))) AS i FROM tx),
pr AS (SELECT doc_id, i, lower(t[i]) AS a, lower(t[i + 1]) AS b, t[i:i + (SELECT max(k) FROM pl)] AS g FROM ps),
hit AS (SELECT doc_id, i, k, phrase FROM pr JOIN pl ON a = lower(p[1]) AND b = lower(p[2])
        WHERE len(g) >= k AND list_bool_and(list_transform(range(1, k + 1), lambda j: {fit.format('p[j]', 'g[j]')}))),
lo AS (SELECT doc_id, i, max(k) AS k, arg_max(phrase, (k, phrase)) AS phrase FROM hit GROUP BY ALL)"""


def oracle_sql() -> dict[str, str]:
    tags = "|".join(IGNORED_TAGS)
    sql: dict[str, str] = {}

    # sources and sinks
    sql["scan_dump"] = f"{with_(CORPUS)} SELECT * FROM corpus"
    sql["scan_namespaces"] = (
        f"{with_(CORPUS)} SELECT DISTINCT ns AS ns_key, CASE ns WHEN 10 THEN 'Template' ELSE '' END AS ns_name FROM corpus"
    )
    sql["scan_urlbase"] = "SELECT 'https://wiki.example.org/wiki' AS urlbase"
    sql["docs_roundtrip"] = f"{with_(*FULL)} SELECT page_id, rev_id, title, text FROM art"
    sql["json_roundtrip"] = f"""{with_(*FULL)} SELECT CAST(page_id AS VARCHAR) AS id,
        'https://wiki.example.org/wiki?curid=' || page_id AS url, title, title || {NL} || {NL} || text AS text,
        CAST(rev_id AS VARCHAR) AS revid FROM art"""
    sql["category_rules"] = rf"""SELECT DISTINCT ltrim(trim(line), '^') AS category,
        CASE WHEN trim(line) LIKE '^%' THEN 'exclude' ELSE 'include' END AS mode
        FROM (SELECT {RULE_LINES} AS line FROM customer) WHERE trim(line) <> '' AND trim(line) NOT LIKE '#%'"""
    lines = """'artid=' || page_id || ';senid=' || sid || ';link=' || {0}link{1} || ';dates=[' || dates || ']' ||
        ';sentence=' || {0}sentence{1}""".format("regexp_replace(", r", '([;\\])', '\\\1', 'g')")
    sql["format_pairs"] = f"{with_(*PAIRED)} SELECT page_id, sid, link_ord, {lines} AS line FROM pairs"
    sql["pair_files"] = f"{with_(*PAIRED)} SELECT {lines} AS line FROM pairs"
    sql["versioned_articles"] = f"""{with_(*BASE)} SELECT page_id, rev_id, title, 1 AS version FROM pg
        UNION ALL SELECT page_id, rev_id + 1, title, 2 FROM pg WHERE page_id % 3 <> 0"""
    sql["clustered_range"] = "SELECT doc_id AS page_id, n_chars, md5(text) AS text_md5 FROM documents WHERE doc_id BETWEEN 100 AND 160"
    sql["bounded_pairs"] = f"{with_(*PAIRED)} SELECT {lines} AS line, true AS fits FROM pairs"

    # filters
    sql["keep_articles"] = f"{with_(*BASE)} SELECT page_id, rev_id, title FROM pg"
    sql["drop_disambig"] = f"""{with_(*BASE)} SELECT page_id, title FROM pg
        WHERE NOT list_bool_or(list_transform(string_split(wikitext, {NL}), lambda x: starts_with(x, '{{{{disambig}}}}')))"""
    cats = rf"regexp_extract_all(wikitext, '\[\[Category:([^|\]]+)', 1)"
    categories = f"cat AS (SELECT DISTINCT page_id, unnest({cats}) AS category FROM pg)"
    sql["page_categories"] = f"{with_(*BASE, categories)} SELECT page_id, category FROM cat"
    rules = ", ".join(f"({quoted(c)}, {quoted(m)})" for c, m in CATEGORY_RULES)
    filtered = f"""rules(category, mode) AS (VALUES {rules}),
        inc AS (SELECT DISTINCT page_id FROM cat JOIN rules USING (category) WHERE mode = 'include'),
        exc AS (SELECT DISTINCT page_id FROM cat JOIN rules USING (category) WHERE mode = 'exclude')"""
    sql["filter_categories"] = f"""{with_(*BASE, categories, filtered)} SELECT page_id, title FROM pg
        WHERE page_id IN (FROM inc) AND page_id NOT IN (FROM exc)"""
    sql["category_pairs"] = f"""{with_(*PAIRED, categories, filtered)} SELECT * FROM pairs
        WHERE page_id IN (FROM inc) AND page_id NOT IN (FROM exc)"""
    sql["filter_categories_join"] = f"""{with_(*BASE)}, two AS (SELECT page_id, rev_id, wikitext FROM pg UNION ALL
        SELECT page_id, rev_id + 1, CASE WHEN page_id % 2 = 1 THEN replace(wikitext, '[[Category:', '[[Topic:') END FROM pg WHERE page_id % 7 = 0)
        SELECT page_id, rev_id FROM two WHERE NOT list_has_any(coalesce({cats}, []), ['NATION_15 in 1998', 'FURNITURE'])"""
    sql["id_range"] = "SELECT doc_id AS page_id, lang, n_chars FROM documents WHERE doc_id >= 100 AND doc_id <= 900"
    sql["min_length"] = f"""SELECT doc_id AS page_id, n_chars FROM documents
        WHERE length(source || {NL}) + length(replace(text, {NL}, '')) >= 1000"""

    # cleaning
    sql["clean_text"] = f"{with_(*FULL)} SELECT page_id, rev_id, title, text FROM art"
    sql["drop_templates"] = step(rx("wikitext", TEMPLATE, TEMPLATE, TEMPLATE))
    sql["drop_tables"] = step(rx("wikitext", (r"\{\|[^{]*?\|\}", "")))
    sql["keep_tables"] = step(
        "replace(replace(" + rx("wikitext", (r'! ?style="[a-z]+:[0-9]+%;"', "")) + ", '|-', ''), '|', '')", TABLE_TEXT
    )
    sql["strip_emphasis"] = step(rx("wikitext", BOLD, ITALIC))
    accepted = rx("wikitext", (r"\[\[(w:[^\[\]|]*)\|([^\[\]|]*)\]\]", r'<a href="\1">\2</a>'))
    linked = rx(
        accepted, (r"\[\[:[^\[\]|:]+:[^\[\]]*\]\]", ""), FOREIGN,
        (r"\[\[([^\[\]|]*)\|x\|([^\[\]|]*?) *\]\]", r'<a href="\1">\2</a>'), PIPED, PLAIN, FOREIGN,
    )
    sql["strip_links"] = step(linked, LINK_TEXT)
    sql["link_labels"] = step(rx(linked, (r'<a href="[^"]*">([^<]*)</a>', r"\1")), LINK_TEXT)
    # addresses are encoded piece by piece, after the links have become anchors
    anchors = f"string_split({rx(ENCODED_TEXT, FOREIGN, PIPED, PLAIN)}, '<a href=\"')"
    address = "replace(url_encode(string_split(p, '\"')[1]), '%2F', '/') || substr(p, strpos(p, '\"'))"
    sql["encoded_links"] = f"""{with_(*BASE)} SELECT page_id, a[1] || array_to_string(
        list_transform(a[2:], lambda p: '<a href="' || {address}), '') AS text FROM (SELECT page_id, {anchors} AS a FROM pg)"""
    sql["drop_external_links"] = step(rx("wikitext", EXTERNAL))
    sql["drop_switches"] = step("replace(wikitext, '__NOTOC__', '')")
    ents = "html"
    for name, char in (("&middot;", 183), ("&copy;", 169), ("&quot;", 34), ("&lt;", 60), ("&gt;", 62), ("&nbsp;", 160), ("&amp;", 38)):
        ents = f"replace({ents}, '{name}', chr({char}))"
    sql["unescape_entities"] = f"SELECT page_id, {ents} AS text FROM pages"
    sql["drop_comments"] = f"SELECT page_id, {rx('html', ('(?s)<!--.*?-->', ''))} AS text FROM pages"
    sql["drop_selfclosing"] = step("replace(wikitext, '<br/>', '')")
    sql["strip_tags"] = "SELECT page_id, " + rx("html", (rf"(?i)<(?:{tags})\b[^>]*>", ""), (rf"(?i)</(?:{tags})>", "")) + " AS text FROM pages"
    sql["drop_elements"] = "SELECT page_id, " + rx(
        "html", *[(rf"(?is)<{t}(?: [^>/]*)?>.*?</{t}>", "") for t in ("li", "ul", "div")]
    ) + " AS text FROM pages"
    sql["placeholders"] = step(
        "replace(replace(replace(wikitext, '<math>x+1</math>', 'formula_1'), '<math>' || title || '</math>', 'formula_2'),"
        " '<code>a</code>', 'codice_1')", PLACEHOLDER_TEXT,
    )
    norm = "replace(replace(replace(wikitext, '<<', '«'), '>>', '»'), chr(9), ' ')"
    norm = rx(norm, ("  +", " "), (r"\.\.\.\.+", "..."))
    norm = f"regexp_replace({norm}, '\\n[^\\p{{L}}\\p{{N}}_]+?\\n', {NL}, 'g')"
    sql["normalize_text"] = step(f"replace(replace({norm}, ',,', ','), ',.', '.')", NORMALIZE_TEXT)
    # the body stays as it is: a word stands for it while the rest of the page is cleaned
    code = "wikitext || chr(10) || 'code ' || title || '<b>x</b> CODEBODY end &lt;'"
    sql["code_bodies"] = f"""{with_(CORPUS, pages_with(code), articles())} SELECT page_id,
        replace(text, 'CODEBODY', 'SELECT <b>' || title || '</b> &lt; 1') AS text FROM art"""
    sql["nowiki_spans"] = (
        f"{with_(*BASE)} SELECT page_id, '<nowiki>{{{{x|' || title || '}}}}</nowiki> ' || "
        + rx("wikitext", TEMPLATE, TEMPLATE, TEMPLATE) + " AS text FROM pg"
    )
    sql["article_lines"] = f"""{with_(*FULL)} SELECT page_id, unnest(string_split(text, {NL})) AS line,
        CAST(generate_subscripts(string_split(text, {NL}), 1) - 1 AS INT) AS line_no FROM art"""
    sql["text_without_lists"] = f"""{with_(CORPUS, pages_with(LIST_TEXT), articles(keep_lists=False))}
        SELECT page_id, rev_id, title, text FROM art"""
    sql["headings"] = rf"""{with_(*BASE)}, tx AS (SELECT page_id, {HEADING_TEXT} AS t FROM pg),
        ln AS (SELECT page_id, unnest(string_split(t, {NL})) AS line, generate_subscripts(string_split(t, {NL}), 1) AS n FROM tx),
        kd AS (SELECT *, length(regexp_extract(line, '^(==+)', 1)) AS level FROM ln),
        hd AS (SELECT page_id, n, level, regexp_replace(line, '^=+ *(.*?) *=+$', '\1') AS title FROM kd WHERE level > 0),
        nx AS (SELECT h.page_id, h.n, h.level, h.title, min(k.n) AS stop FROM hd h LEFT JOIN kd k
               ON k.page_id = h.page_id AND k.n > h.n AND k.level BETWEEN 1 AND h.level GROUP BY ALL),
        fl AS (SELECT x.page_id, x.n, x.level, x.title, count(k.n) > 0 AS filled FROM nx x LEFT JOIN kd k
               ON k.page_id = x.page_id AND k.n > x.n AND k.level = 0 AND k.line <> '' AND (x.stop IS NULL OR k.n < x.stop) GROUP BY ALL)
        SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS INT) AS heading_no, CAST(level AS INT) AS level,
               CASE WHEN title LIKE '%?' THEN title ELSE title || '.' END AS title, filled FROM fl"""
    sql["list_items"] = rf"""{with_(*BASE)}, tx AS (SELECT page_id, {LIST_TEXT} AS t FROM pg),
        ln AS (SELECT page_id, unnest(string_split(t, {NL})) AS line, generate_subscripts(string_split(t, {NL}), 1) AS n FROM tx),
        pf AS (SELECT *, regexp_extract(line, '^[*#;]+', 0) AS p FROM ln),
        li AS (SELECT *, length(p) AS d FROM pf),
        br AS (SELECT *, max(CASE WHEN left(p, 1) <> '#' THEN n END) OVER w AS b1,
                         max(CASE WHEN left(p, 2) <> '##' THEN n END) OVER w AS b2 FROM li WINDOW w AS (PARTITION BY page_id ORDER BY n)),
        nm AS (SELECT *, count(*) FILTER (WHERE p = '#') OVER (PARTITION BY page_id, b1 ORDER BY n) AS c1,
                         count(*) FILTER (WHERE p = '##') OVER (PARTITION BY page_id, b2 ORDER BY n) AS c2 FROM br)
        SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS INT) AS item_no,
               CASE WHEN p = '#' THEN c1 || '.'
                    WHEN p LIKE '%#' THEN c2 || '.' ELSE '-' END AS marker,
               trim(substr(line, d + 1)) AS item FROM nm WHERE d > 0"""

    # extraction
    sql["links"] = rf"""{with_(*FULL)}, hit AS (SELECT page_id, unnest(regexp_extract_all(text, '{ANCHOR}')) AS a,
        CAST(generate_subscripts(regexp_extract_all(text, '{ANCHOR}'), 1) - 1 AS INT) AS link_no FROM art)
        SELECT page_id, link_no, regexp_extract(a, '"([^"]*)"', 1) AS link, regexp_extract(a, '>([^<]*)<', 1) AS label FROM hit"""
    sql["undated_links"] = rf"""{with_(CORPUS, pages_with(STACKED_TEXT), articles())}, hit AS (
          SELECT page_id, unnest(regexp_extract_all(text, '{ANCHOR}')) AS a, generate_subscripts(regexp_extract_all(text, '{ANCHOR}'), 1) AS n FROM art),
        parts AS (SELECT page_id, n, regexp_extract(a, '"([^"]*)"', 1) AS link, regexp_extract(a, '>([^<]*)<', 1) AS label FROM hit)
        SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS INT) AS link_no, link, label
        FROM parts WHERE NOT regexp_matches(link, '\b\d{{4}}\b')"""
    web = r"""<a href="[^"]*">[^<]*</a>"""
    sql["page_links"] = rf"""WITH hit AS (SELECT page_id, unnest(regexp_extract_all(html, '{web}')) AS a,
        CAST(generate_subscripts(regexp_extract_all(html, '{web}'), 1) - 1 AS INT) AS link_no FROM pages)
        SELECT page_id, link_no, regexp_extract(a, '"([^"]*)"', 1) AS link, regexp_extract(a, '>([^<]*)<', 1) AS label FROM hit"""
    cut = "list_transform(string_split(text, 'Section::::'), lambda x, i: CASE WHEN i = 1 THEN x ELSE 'Section::::' || x END)"
    sql["sections"] = f"""{with_(*BASE, articles(keep_sections=True))} SELECT page_id, unnest({cut}) AS section,
        CAST(generate_subscripts({cut}, 1) - 1 AS INT) AS section_no FROM art"""
    sql["sentences"] = f"{with_(*FULL, split_sentences('art', 'text'))} SELECT page_id, sid, sentence FROM sen"
    sql["document_sentences"] = f"""{with_('doc AS (SELECT doc_id AS page_id, text FROM documents)', split_sentences('doc', 'text'))}
        SELECT page_id, sid, sentence FROM sen"""
    surface = "replace(m, ' – ', '-')"
    sql["date_mentions"] = f"{with_(*SENTENCES, mentions())} SELECT page_id, sid, pos, value, {surface} AS surface FROM men WHERE NOT is_link"
    sql["only_dates"] = f"""{with_(CORPUS, pages_with(TIMES_TEXT), articles(), split_sentences('art', PROSE), mentions())}
        SELECT page_id, sid, pos, value FROM men WHERE NOT is_link"""
    stored_form = f"""whole AS (SELECT page_id, '<doc id="' || page_id || '" revid="' || rev_id || '" title="' || title || '">' || {NL} ||
        title || {NL} || {NL} || text || {NL} || {NL} || '</doc>' || {NL} AS text FROM art)"""
    sql["whole_sentences"] = f"{with_(*FULL, stored_form, split_sentences('whole', 'text'))} SELECT page_id, sid, sentence FROM sen"
    sql["intervals"] = sql["date_mentions"] + " AND value LIKE '[%'"
    sql["normalize_dates"] = rf"""WITH v AS (SELECT o_orderkey, {DATE_VALUES} AS value
          FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS STRING) AS y FROM orders))
        SELECT o_orderkey, value, CASE
          WHEN regexp_matches(value, '^(BC)?\d{{4}}-\d\d$') THEN value
          WHEN regexp_matches(value, '^(BC)?\d{{4}}') THEN regexp_extract(value, '^(BC)?\d{{4}}')
          WHEN regexp_matches(value, '^(BC)?\d{{3}}$') THEN 'DECADE ' || value
          WHEN regexp_matches(value, '^(BC)?\d\d$') THEN 'CENTURY ' || value
          WHEN regexp_matches(value, '^\[(BC)?\d{{4}}[-0-9]*,(BC)?\d{{4}}[-0-9]*\]$') THEN value END AS date FROM v"""
    sql["pair_dates"] = f"{with_(*PAIRED)} SELECT * FROM pairs"
    sql["pair_mentions"] = f"{with_(*PAIRED)} SELECT page_id, sid, link_ord, link, dates FROM pairs"
    # a link with a year in its title is none; the dates in its label count
    undated = articles() + """,
        art0 AS (SELECT page_id, title, regexp_replace(text, '<a href="[^"]*\\b\\d{4}\\b[^"]*">', '', 'g') AS text FROM art)"""
    sql["stacked_links"] = f"""{with_(CORPUS, pages_with(STACKED_TEXT), undated, split_sentences("art0", PROSE), mentions(), PAIRS)}
        SELECT page_id, sid, link_ord, link, dates FROM pairs"""
    sql["templates"] = rf"""{with_(CORPUS)} SELECT title, arg_max(body, page_id) AS body, max(page_id) AS page_id FROM (
        SELECT title, page_id, CASE WHEN wikitext LIKE '%<onlyinclude>%' THEN regexp_extract(wikitext, '<onlyinclude>(.*)</onlyinclude>', 1)
          ELSE regexp_replace(regexp_replace(wikitext, '<noinclude>.*</noinclude>', ''), '</?includeonly>', '', 'g') END AS body
        FROM corpus WHERE ns = 10) WHERE body <> '' GROUP BY title"""
    redirects = rf"red AS (SELECT title AS from_title, regexp_extract(wikitext, '\[\[(.*)\]\]', 1) AS to_title FROM corpus WHERE wikitext LIKE '#REDIRECT%')"
    sql["redirects"] = f"{with_(CORPUS, redirects)} SELECT from_title, to_title FROM red"
    sql["resolve_redirects"] = f"""{with_(CORPUS, redirects)} SELECT o_orderkey AS page_id, coalesce(to_title, l) AS link
        FROM (SELECT o_orderkey, 'Order ' || CAST(o_orderkey * 3 % 1000 AS STRING) AS l FROM orders) LEFT JOIN red ON l = from_title"""
    box = [rf"regexp_extract(wikitext, '^\{{\{{Box (\d+)\|([^|]*)\|year=(\d+)', {i})" for i in range(4)]
    first = f"""SELECT page_id, 'Template:Box ' || {box[1]} AS template,
          '1=' || {box[2]} || '|cite=|year=' || {box[3]} AS params FROM pg"""
    cite = f"SELECT page_id, 'Template:Cite' AS template, '1=' || {box[3]} AS params FROM pg"
    extra = """SELECT page_id, 'Template:Disambig' AS template, '' AS params FROM pg WHERE page_id % 50 = 0
        UNION ALL SELECT page_id, 'Template:Quote box', '1=a|2=B|3=[[X|y]] |k=last' FROM pg
        UNION ALL SELECT page_id, 'Main ' || title, '' FROM pg"""
    sql["template_calls"] = f"{with_(*BASE)} {first} UNION ALL {cite} UNION ALL {extra}"
    calls = f"call AS ({first} UNION ALL {cite} UNION ALL SELECT page_id, 'Template:Disambig', '' FROM pg WHERE page_id % 50 = 0)"
    known = f"tpl AS (SELECT * FROM ({sql['templates'].replace(with_(CORPUS), '')}))"
    usage = (*BASE, known, calls, "cnt AS (SELECT template, count(*) AS calls FROM call GROUP BY template)")
    sql["template_usage"] = f"""{with_(*usage)} SELECT template, calls, body IS NOT NULL AS defined, coalesce(body, '') AS body
        FROM cnt LEFT JOIN tpl ON template = title"""
    sql["missing_templates"] = f"{with_(*usage)} SELECT template, calls FROM cnt WHERE template NOT IN (SELECT title FROM tpl)"
    edges = rf"""pages AS ({TEMPLATE_PAGES}),
        hop AS (SELECT title AS f, regexp_extract(wikitext, '\[\[(.*)\]\]', 1) AS t FROM pages WHERE wikitext LIKE '#REDIRECT%'),
        way(f, t) AS (SELECT f, t FROM hop UNION SELECT way.f, hop.t FROM way JOIN hop ON way.t = hop.f),
        ends AS (SELECT f, t FROM way WHERE t NOT IN (SELECT f FROM hop)),
        named AS (SELECT title AS template, unnest(regexp_extract_all(replace(wikitext, '{{{{Manual}}}}', ''), '\{{\{{([A-Za-z]+ \d+)', 1)) AS n
          FROM pages WHERE wikitext NOT LIKE '#REDIRECT%'),
        edge AS (SELECT DISTINCT template, coalesce(t, 'Template:' || upper(left(n, 1)) || substr(n, 2)) AS uses
          FROM named LEFT JOIN ends ON f = 'Template:' || upper(left(n, 1)) || substr(n, 2))"""
    closure = f"""{edges},
        reach(template, uses, depth) USING KEY (template, uses) AS (SELECT template, uses, 1 FROM edge UNION
          SELECT r.template, e.uses, min(r.depth) + 1 FROM reach r JOIN edge e ON r.uses = e.template
          WHERE NOT EXISTS (SELECT 1 FROM recurring.reach k WHERE k.template = r.template AND k.uses = e.uses) GROUP BY ALL)"""
    sql["template_edges"] = f"WITH RECURSIVE {edges} SELECT template, uses FROM edge"
    sql["template_closure"] = f"WITH RECURSIVE {closure} SELECT template, uses, CAST(depth AS INTEGER) AS depth FROM reach"
    sql["template_reach"] = f"""WITH RECURSIVE {closure},
        named_calls AS (SELECT unnest(regexp_extract_all({PART_CALLS}, '\\{{\\{{([A-Za-z]+ \\d+)', 1)) AS n FROM lineitem),
        cnt AS (SELECT coalesce(t, 'Template:' || n) AS template, count(*) AS calls FROM named_calls LEFT JOIN ends ON f = 'Template:' || n GROUP BY 1),
        both_ AS (SELECT template, calls AS direct, 0 AS nested FROM cnt UNION ALL
          SELECT uses, 0, calls FROM cnt JOIN reach USING (template) WHERE template <> uses)
        SELECT template, CAST(sum(direct) AS BIGINT) AS direct, CAST(sum(nested) AS BIGINT) AS nested FROM both_ GROUP BY template"""
    sql["title_parts"] = rf"""WITH v AS (SELECT p_partkey, {PART_TITLES} AS t FROM part),
        q AS (SELECT *, strpos(t, ':') AS c FROM v), r AS (SELECT *, substr(t, c + 1) AS page FROM q),
        s AS (SELECT *, string_split(page, '/') AS l FROM r)
        SELECT p_partkey, CASE WHEN c > 0 THEN left(t, c - 1) ELSE '' END AS namespace, page,
          CASE WHEN len(l) > 1 THEN array_to_string(l[1:len(l)-1], '/') ELSE page END AS base,
          CASE WHEN len(l) > 1 THEN l[len(l)] ELSE '' END AS sub, l[1] AS root FROM s"""
    ucf = "upper(left({0}, 1)) || substr({0}, 2)"
    sql["normalize_titles"] = rf"""WITH v AS (SELECT p_partkey, p_name, p_brand, {TITLES} AS title FROM part)
        SELECT p_partkey, title, CASE p_partkey % 5 WHEN 0 THEN {ucf.format('p_name')} || ' x y'
          WHEN 1 THEN 'Template:' || {ucf.format('p_name')} WHEN 2 THEN {ucf.format('p_brand')} || ':' || {ucf.format('p_name')}
          WHEN 3 THEN {ucf.format('p_brand')} || ': ' || {ucf.format('p_name')} ELSE ':' || {ucf.format('p_name')} END AS normalized FROM v"""

    # joins and aggregates
    sql["incremental"] = f"""{with_(CORPUS, f'old AS ({OLD_PAGES})')} SELECT c.page_id, c.rev_id,
        CASE WHEN o.page_id IS NULL THEN 'changed' ELSE 'reusable' END AS status
        FROM corpus c LEFT JOIN old o ON c.page_id = o.page_id AND c.rev_id = o.rev_id"""
    sql["update_articles"] = f"""{with_(*FULL)} SELECT page_id, rev_id, title,
        CASE WHEN page_id % 5 <> 0 AND page_id % 3 <> 0 THEN 'stored ' || title ELSE text END AS text FROM art"""
    sql["dedupe_pages"] = f"""{with_(CORPUS, f'dup AS ({DUPLICATED})')} SELECT page_id, rev_id, title FROM dup
        QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY rev_id DESC) = 1"""
    sql["merge_buckets"] = sql["update_articles"]
    sql["dedupe_stored"] = sql["dedupe_pages"].replace("SELECT page_id, rev_id, title FROM dup", "SELECT page_id, rev_id, title, md5(wikitext) AS text_md5 FROM dup")
    sql["corpus_stats"] = f"""{with_(*BASE)} SELECT (SELECT count(*) FROM corpus) AS pages, (SELECT count(*) FROM pg) AS articles,
        (SELECT count(*) FROM pg WHERE wikitext NOT LIKE '%' || {NL} || '{{{{disambig}}}}%') AS kept"""
    sql["counted_extract"] = sql["corpus_stats"]
    dated = """dt AS (SELECT link, unnest(string_split(regexp_replace(dates, '(\\d),(\\d{4}\\])', '\\1~\\2', 'g'), ',')) AS d FROM pairs),
        kn AS (SELECT link, CASE WHEN d LIKE 'DEC%' THEN 'decade' WHEN d LIKE 'CEN%' THEN 'century' WHEN d LIKE '[%' THEN 'interval' ELSE 'date' END AS kind,
          CAST(floor(CASE WHEN d LIKE 'DEC%' THEN CAST(right(d, 3) AS INT) * 10 WHEN d LIKE 'CEN%' THEN CAST(right(d, 2) AS INT) * 100
               WHEN d LIKE '[%' THEN CAST(substr(d, 2, 4) AS INT) WHEN d LIKE 'BC%' THEN -CAST(right(d, 4) AS INT) ELSE CAST(d AS INT) END / 100.0) AS INT) AS century FROM dt)"""
    sql["date_kind_counts"] = f"{with_(*PAIRED, dated)} SELECT link, kind, count(*) AS n FROM kn GROUP BY ALL"
    sql["link_timeline"] = f"""{with_(*PAIRED, dated)} SELECT kind, century, count(*) AS n, count(DISTINCT link) AS links
        FROM kn GROUP BY ROLLUP (kind, century)"""

    # tokens are rows here, and their classes come from a join
    listed = ", ".join(f"({quoted(lang)}, {quoted(w)}, {quoted(k)})" for lang, ws in date_words().items() for w, k in ws.items())
    sql["dates_by_language"] = f"""WITH dict(lang, word, kind) AS (VALUES {listed}),
        tk AS (SELECT doc_id, lang, unnest(toks) AS tok, generate_subscripts(toks, 1) AS i
          FROM (SELECT doc_id, lang, regexp_extract_all({DATED_TEXT.replace("AS STRING", "AS VARCHAR")}, {quoted(TOKEN)}) AS toks FROM documents)),
        pt AS (SELECT *, regexp_extract(tok, '^[0-9]*') AS num, regexp_replace(tok, '^[0-9]+', '') AS tail FROM tk),
        cl AS (SELECT doc_id, i, tok, CASE WHEN tok = '.' THEN 'p' WHEN tok = ',' THEN 'q'
            WHEN num = '' AND kind NOT IN ('s', 't') THEN kind WHEN num = '' THEN 'x'
            WHEN (tail = '' OR kind = 's') AND length(num) < 3 AND TRY_CAST(num AS INT) BETWEEN 1 AND 31 THEN 'd'
            WHEN tail = '' AND length(num) = 4 THEN 'y' WHEN tail = '' AND length(num) < 4 THEN 'n'
            WHEN kind = 't' AND length(num) = 4 AND num LIKE '%0' THEN 'k' ELSE 'x' END AS kind
          FROM pt LEFT JOIN dict ON pt.lang = dict.lang AND lower(tail) = word),
        rw AS (SELECT doc_id, string_agg(coalesce(kind, 'x') || ':' || tok || ' ', '' ORDER BY i) AS r FROM cl GROUP BY doc_id),
        mt AS (SELECT doc_id, unnest(m) AS f, generate_subscripts(m, 1) AS ord FROM (SELECT doc_id, regexp_extract_all(r, {quoted(SHAPES)}) AS m FROM rw)),
        pc AS (SELECT *, regexp_extract(f, 'd:(\\d+)', 1) AS d, regexp_extract(f, 'm(\\d\\d):', 1) AS m, regexp_extract(f, 'y:(\\d+)', 1) AS y FROM mt)
        SELECT doc_id, CAST(ord AS INT) AS ord, rtrim(regexp_replace(f, '(^| )[a-z]\\d*:', '\\1', 'g')) AS surface,
          CASE WHEN regexp_matches(f, '(^| )[cg]:') THEN lpad(CAST(CAST(d AS INT) - 1 AS VARCHAR), 2, '0')
            WHEN regexp_matches(f, ' [eh]:') THEN 'BC' || lpad(regexp_extract(f, '^[dny]:(\\d+)', 1), 4, '0')
            WHEN f LIKE 'k:%' THEN substr(f, 3, 3) WHEN m <> '' AND d <> '' THEN y || '-' || m || '-' || lpad(d, 2, '0')
            WHEN m <> '' THEN y || '-' || m ELSE y END AS value FROM pc"""

    # tokens
    plain = TOKENS.format(body="list_concat(parts, CASE WHEN stops THEN ['.'] ELSE [] END)", join="")
    sql["token_counts"] = f"{with_(words(), CLITICS, plain)} SELECT lang, token, n FROM tc"
    listed = TOKENS.format(
        body="""CASE WHEN a.word IS NOT NULL THEN [core] WHEN b.word IS NOT NULL AND stops THEN [stem, '.']
             ELSE list_concat(parts, CASE WHEN stops THEN ['.'] ELSE [] END) END""",
        join="LEFT JOIN ab a ON core = a.word LEFT JOIN ab b ON stem = b.word",
    )
    abbreviations = f"ab AS (SELECT word || '.' AS word FROM ({ABBREVIATIONS}) WHERE word <> '')"
    sql["abbrev_tokens"] = f"{with_(words(), CLITICS, abbreviations, listed)} SELECT lang, token, n FROM tc"
    sql["clitics"] = f"""{with_(words(CLITIC_TEXT), CLITICS)} SELECT lang, array_to_string(parts, ' ') AS parts, CAST(sum(n) AS BIGINT) AS n
        FROM w8 WHERE len(parts) > 1 GROUP BY ALL"""
    sql["phrase_counts"] = f"""WITH RECURSIVE {phrase_ctes().strip()},
        od AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS r FROM lo),
        scan AS (SELECT doc_id, i + k AS next, phrase FROM od WHERE r = 1
          UNION ALL SELECT o.doc_id, o.i + o.k, o.phrase FROM scan s, LATERAL (
            SELECT * FROM od WHERE od.doc_id = s.doc_id AND od.i >= s.next ORDER BY od.i LIMIT 1) o)
        SELECT phrase, count(*) AS n FROM scan GROUP BY phrase"""

    # streams
    sql["stream_pairs"] = sql["stream_dump_pairs"] = sql["pair_dates"]
    sql["stream_dedupe"] = f"{with_(CORPUS, f'dup AS ({DUPLICATED})')} SELECT DISTINCT page_id, rev_id, title FROM dup"
    sql["stream_incremental"] = sql["stream_seeded"] = f"{with_(*PAIRED)} SELECT * FROM pairs WHERE page_id % 5 = 0 OR page_id % 3 = 0"

    # scalar mapping
    sql["scalar_strings"] = r"""SELECT p_partkey, lower(p_brand) AS lc, upper(p_name) AS uc,
        upper(left(p_name, 1)) || substr(p_name, 2) AS ucfirst, lower(left(p_brand, 1)) || substr(p_brand, 2) AS lcfirst,
        replace(url_encode(p_name || '/' || p_brand || '*~'), '%2F', '/') AS urlencode, CAST(CAST(p_size AS VARCHAR) AS INT) AS int_value,
        CAST(length(p_name) AS INT) AS len, substr(p_name, 2, 3) AS sub, left(substr(p_name, 3), greatest(length(p_name) - 3, 0)) AS sub_negative,
        substr(p_name, 3, 4) AS sublength, substr(p_name, 2, 1) AS pos, CAST(strpos(p_name, 'e') AS INT) AS find,
        replace(p_name, 'e', 'E') AS replaced, regexp_replace(p_name, '[aeiou]', '_', 'g') AS replaced_regex, p_brand || p_brand AS rep FROM part"""
    sql["scalar_logic"] = """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'ok' END AS if_value,
        CASE WHEN c_mktsegment = 'BUILDING' THEN 'yes' ELSE 'no' END AS ifeq,
        CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'house' WHEN c_mktsegment = 'MACHINERY' THEN 'work' ELSE 'other' END AS switch,
        CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN c_mktsegment ELSE 'none' END AS if_empty FROM customer"""
    return sql
