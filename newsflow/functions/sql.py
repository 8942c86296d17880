"""Spark SQL text for the column functions.

The column functions of ``text.py`` / ``entry.py`` / ``vector.py`` are built
as Spark SQL expression *text* and turned into a Column with one ``expr``
call (operators use one ``selectExpr`` per projection). Building an
expression node by node from Python costs one JVM round trip per node, which
made planning, not execution, dominate small queries; as text it is parsed in
the JVM in one go. The expressions are the same built-in functions either way
(codegen, no Python at run time).

Every builder takes SQL expression strings and returns one.
"""

from __future__ import annotations

from html.entities import html5              # the public table of named references

from .. import config as C

# --- fixed values -------------------------------------------------------------
# Python's str.isspace() set, written as a regex class that Java regex and RE2
# read the same way.
WS_CLASS = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")

# How HTML reads numeric character references that name no character: C1 controls as windows-1252, the rest as they say.
ODD_REFERENCES = {0: "\ufffd", 13: "\r", **{n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}}

SCRIPT_STYLE_RE = r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>"
COMMENT_RE = r"(?s)<!--.*?-->"
TAG_RE = r"<[a-zA-Z/!?][^>]*>"            # a bare "<" is text
AUTHORITY_RE = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)"   # urllib's netloc
SCHEME_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*://"
LETTER_RUNS_RE = r"(\p{L}+|\P{L}+)"
ISO_FMT = "yyyy-MM-dd'T'HH:mm:ss"
BIG = 1 << 30


def lit(s: str) -> str:
    """A Spark SQL string literal for any text."""
    return "'" + (s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
                  .replace("\t", "\\t").replace("\r", "\\r")) + "'"


def ident(name: str) -> str:
    """A (possibly nested, ``a.b``) column reference."""
    return ".".join(f"`{p}`" for p in name.split("."))


def rr(x: str, pattern: str, rep: str) -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(rep)})"


def rep(x: str, a: str, b: str) -> str:
    return f"replace({x}, {lit(a)}, {lit(b)})"


def nz(x: str) -> str:
    return f"coalesce({x}, '')"


# --- whitespace -----------------------------------------------------------------

def strip(x: str) -> str:
    return rr(x, f"^{WS_CLASS}+|{WS_CLASS}+$", "")


def collapse_ws(x: str) -> str:
    return f"trim({rr(x, WS_CLASS + '+', ' ')})"


def words(x: str) -> str:
    """Python ``x.split()`` (collapse + split on ' ' measured 3x faster than
    extracting non-whitespace runs with a regex)."""
    return f"filter(split({collapse_ws(nz(x))}, ' '), w -> w != '')"


def word_count(x: str) -> str:
    return f"CAST(size({words(x)}) AS BIGINT)"


def truncate_ellipsis(x: str, n: int) -> str:
    return f"(CASE WHEN length({x}) > {int(n)} THEN concat(substring({x}, 1, {int(n)}), '...') ELSE {x} END)"


def nullif_empty(x: str) -> str:
    return f"nullif({x}, '')"


# --- HTML -------------------------------------------------------------------------

CELLS = 64                       # strings that the table of references is dealt into


def _cell(name: str) -> int:
    return (ord(name[0]) * 7 + ord(name[1:2] or "\0")) % CELLS


def reference_table() -> str:
    """The table as an array of strings ``\\1 name \\2 text \\1 name ...``; a name is looked for in one of them."""
    cells = ["\1"] * CELLS
    for name, text in sorted(html5.items()):
        cells[_cell(name)] += f"{name}\2{text}\1"
    return "array(" + ", ".join(lit(c) for c in cells) + ")"


def reference_text(table: str, name: str) -> str:
    """What ``name`` (with or without its semicolon) stands for; empty if it is not in the table."""
    cell = f"element_at({table}, pmod(ascii({name}) * 7 + ascii(substring({name}, 2, 1)), {CELLS}) + 1)"
    return f"substring_index(split_part({cell}, concat('\1', {name}, '\2'), 2), '\1', 1)"


def numeric_reference(r: str) -> str:
    """The character of ``#65;``, ``#x41`` and so on."""
    many = 1 << 21
    dec, hexa = f"regexp_extract({r}, '^#0*([0-9]*)', 1)", f"regexp_extract({r}, '^#[xX]0*([0-9a-fA-F]*)', 1)"
    num = (f"CASE WHEN {r} RLIKE '^#[xX]' THEN IF(length({hexa}) > 6, {many}, CAST(conv(concat('0', {hexa}), 16, 10) AS BIGINT)) "
           f"WHEN length({dec}) > 7 THEN {many} ELSE CAST(concat('0', {dec}) AS BIGINT) END")
    odd = "map(" + ", ".join(f"{n}L, {lit(c)}" for n, c in ODD_REFERENCES.items()) + ")"
    out = (f"CASE WHEN n < 160 AND map_contains_key({odd}, n) THEN try_element_at({odd}, n) "
           f"WHEN n > 1114111 OR n BETWEEN 55296 AND 57343 THEN '\ufffd' "
           f"WHEN n BETWEEN 1 AND 8 OR n = 11 OR n BETWEEN 14 AND 31 OR n = 127 OR n BETWEEN 64976 AND 65007 OR (n & 65534) = 65534 THEN '' "
           f"ELSE decode(unhex(lpad(hex(n), 8, '0')), 'UTF-32') END")
    return f"transform(array({num}), n -> {out})[0]"


def decode_entities(x: str) -> str:
    """Character references, in one pass, as HTML reads them: ``&name;``, ``&name`` where the standard's table has it without
    the semicolon (the longest such name, ``&notit`` -> ``¬it``), ``&#65;`` and ``&#x41``. What is none stays as it is."""
    short = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
    prefix = f"regexp_extract(name, '^({short})', 1)"
    named = (f"transform(array({reference_text('t', 'name')}), hit -> CASE WHEN hit != '' THEN concat(hit, substring(p, length(name) + 1, {BIG})) "
             f"ELSE transform(array({prefix}), pre -> IF(pre = '', concat('&', p), concat({reference_text('t', 'pre')}, substring(p, length(pre) + 1, {BIG}))))[0] END)[0]")
    number = f"concat({numeric_reference('name')}, substring(p, length(name) + 1, {BIG}))"
    name = r"regexp_extract(p, '^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)', 1)"
    piece = f"transform(array({name}), name -> CASE WHEN name = '' THEN concat('&', p) WHEN startswith(name, '#') THEN {number} ELSE {named} END)[0]"
    whole = f"array_join(transform(split(x, '&', -1), (p, i) -> IF(i = 0, p, {piece})), '')"
    return f"transform(array({x}), x -> IF(x IS NULL OR NOT contains(x, '&'), x, transform(array({reference_table()}), t -> {whole})[0]))[0]"


def clean_html(x: str) -> str:
    e = nz(x)
    e = rr(e, SCRIPT_STYLE_RE, " ")
    e = rr(e, COMMENT_RE, " ")
    e = rr(e, TAG_RE, " ")
    return collapse_ws(decode_entities(e))


def clean_content(x: str) -> str:
    """HTML -> Markdown (``markdown.to_markdown``), then runs of blank lines and of blanks are made one."""
    from .markdown import to_markdown
    e = to_markdown(rr(rr(x, SCRIPT_STYLE_RE, ""), COMMENT_RE, ""))
    e = rr(e, f"\n{WS_CLASS}*\n", "\n\n")
    e = rr(e, "[ \t]+", " ")
    e = strip(e)
    return f"(CASE WHEN {x} IS NULL OR {x} = '' THEN {x} ELSE {e} END)"


def html_title(html: str) -> str:
    return f"regexp_extract({html}, {lit(r'(?is)<title[^>]*>(.*?)</title>')}, 1)"


# --- names and ids ----------------------------------------------------------------

def title_case(x: str) -> str:
    """Python ``str.title()``; the first letter gets its titlecase form (only
    'ß' -> 'Ss' differs from uppercase in our texts)."""
    return (f"array_join(transform(regexp_extract_all({x}, {lit(LETTER_RUNS_RE)}, 1), "
            f"w -> concat(CASE WHEN substring(w, 1, 1) = 'ß' THEN 'Ss' ELSE upper(substring(w, 1, 1)) END, "
            f"lower(substring(w, 2, {BIG})))), '')")


def slug(x: str) -> str:
    e = rep(f"lower({nz(x)})", " ", "-")
    e = rep(rep(e, "'", ""), '"', "")
    e = rr(e, r"[^a-z0-9\-]", "")
    e = rr(e, "-+", "-")
    return rr(e, "^-+|-+$", "")


def url_authority(url: str) -> str:
    return f"regexp_extract({nz(url)}, {lit(AUTHORITY_RE)}, 1)"


def source_name(feed_url: str) -> str:
    host = f"lower({url_authority(feed_url)})"
    host = f"(CASE WHEN startswith({host}, 'www.') THEN substring({host}, 5, {BIG}) ELSE {host} END)"
    return title_case(f"split({host}, {lit(chr(92) + '.')})[0]")


def md5_of(*xs: str) -> str:
    return "md5(concat(" + ", ".join(nz(x) for x in xs) + "))"


def dedup_key(title: str, url: str) -> str:
    return md5_of(title, url)


def article_id(title: str, link: str, name: str) -> str:
    return f"concat(coalesce(nullif({name}, ''), 'unknown'), '_', {md5_of(title, link)})"


def _id_safe(x: str) -> str:
    return rr(x, "[^a-zA-Z0-9_]", "_")


def processor_source(feed: str) -> str:
    f = f"coalesce({feed}, 'unknown')"
    host = f"split(get(split({f}, '://'), 1), '/')[0]"
    from_url = rep(rep(rep(host, "www.", ""), ".com", ""), ".", "_")
    last = f"element_at(split({f}, '/'), -1)"
    from_path = rep(rep(rep(last, ".xml", ""), ".rss", ""), ".", "_")
    name = _id_safe(f"(CASE WHEN contains({f}, '://') THEN {from_url} ELSE {from_path} END)")
    return f"(CASE WHEN {f} = 'unknown' OR {name} = '' OR {name} = '_' THEN 'unknown' ELSE {name} END)"


def processor_id(title: str, url: str, feed: str) -> str:
    return f"concat({processor_source(feed)}, '_', {md5_of(title, url)})"


def api_source(feed: str) -> str:
    f = f"coalesce({feed}, 'unknown')"
    last = f"element_at(split({f}, '/'), -1)"
    return _id_safe(rep(rep(rep(last, ".xml", ""), ".rss", ""), ".", "_"))


def api_id(title: str, url: str, feed: str) -> str:
    return f"concat({api_source(feed)}, '_', {md5_of(title, url)})"


# --- dates --------------------------------------------------------------------------

def iso_text(ts: str) -> str:
    return f"date_format({ts}, {lit(ISO_FMT)})"


def parse_published(text: str, run_ts: str = C.DEFAULT_RUN_TS) -> str:
    t = strip(nz(text))
    no_wd = rr(t, r"^[A-Za-z]{3},\s*", "")
    rfc = (f"coalesce(try_to_timestamp({no_wd}, 'd MMM yyyy HH:mm:ss z'), "
           f"try_to_timestamp({no_wd}, 'd MMM yyyy HH:mm:ss Z'), try_to_timestamp({no_wd}, 'd MMM yyyy HH:mm z'))")
    iso = f"try_to_timestamp({rr(t, 'Z$', '+00:00')})"
    return iso_text(f"coalesce({rfc}, {iso}, to_timestamp({lit(run_ts)}))")


def rfc822(ts: str) -> str:
    return f"concat(date_format({ts}, 'EEE, dd MMM yyyy HH:mm:ss'), ' GMT')"


def display_date(x: str) -> str:
    ts = f"try_to_timestamp({x})"
    return (f"(CASE WHEN {x} IS NULL OR {x} = '' THEN {lit(C.UNKNOWN_DATE_TEXT)} "
            f"WHEN {ts} IS NULL THEN {lit(C.INVALID_DATE_TEXT)} ELSE date_format({ts}, 'MMM d, yyyy') END)")


def _replace_first(x: str, needle: str) -> str:
    return rr(x, "(?s)^(.*?)" + needle.replace(".", r"\."), "$1")


def display_source(x: str) -> str:
    plain = f"concat(upper(substring({x}, 1, 1)), substring({x}, 2, {BIG}))"
    auth = f"regexp_extract({x}, {lit(AUTHORITY_RE)}, 1)"
    host = f"lower({rr(rr(auth, '^.*@', ''), ':[0-9]*$', '')})"
    for part in ("www.", ".com", ".org", ".net"):
        host = _replace_first(host, part)
    last = rep(rep(f"element_at(split({x}, '/'), -1)", ".xml", ""), ".rss", "")
    return (f"(CASE WHEN {x} IS NULL OR {x} = '' THEN {lit(C.UNKNOWN_SOURCE_TEXT)} "
            f"WHEN NOT contains({x}, 'http') AND NOT contains({x}, '/') THEN {plain} "
            f"WHEN regexp_like({x}, {lit(SCHEME_RE)}) THEN {host} "
            f"WHEN {last} = '' THEN {lit(C.UNKNOWN_SOURCE_TEXT)} ELSE {last} END)")


# --- texts for the model stages -------------------------------------------------------

def embedding_text(title: str, summary: str, content: str, limit: int | None = C.EMBED_TEXT_CHARS) -> str:
    t = (f"concat('Title: ', {nz(title)}, {lit(chr(10) * 2 + 'Summary: ')}, {nz(summary)}, "
         f"{lit(chr(10) * 2 + 'Content: ')}, {nz(content)})")
    return t if limit is None else truncate_ellipsis(t, limit)


def lead_words(x: str, n: int = C.SUMMARY_WORDS) -> str:
    """First ``n`` words joined by one space. The split on whitespace runs is
    limited to n+1 pieces, so the regex stops after n words (the rest stays in
    one last piece, dropped): a 20,000-word text is neither scanned to the end
    nor turned into a 20,000-element array."""
    head = rr(nz(x), f"^{WS_CLASS}+", "")
    return (f"array_join(slice(filter(split({head}, {lit(WS_CLASS + '+')}, {int(n) + 1}), w -> w != ''), "
            f"1, {int(n)}), ' ')")


def tokens(x: str) -> str:
    """The runs of ASCII letters of the lower-cased text."""
    return f"filter(split(trim({rr(f'lower({nz(x)})', '[^a-z]+', ' ')}), ' '), w -> w != '')"


def hash_bucket(w: str, dim: int = C.EMBED_DIM) -> str:
    return f"pmod(CAST(conv(substring(md5({w}), 1, 8), 16, 10) AS BIGINT), {int(dim)})"


def parse_batch_response(text: str, n: str) -> str:
    parts = f"split({nz(text)}, {lit(C.SUMMARY_SEPARATOR)})"
    kept = f"filter(transform({parts}, p -> {strip('p')}), p -> p != '')"
    return f"slice(concat({kept}, array_repeat('', CAST({n} AS INT))), 1, CAST({n} AS INT))"


# --- feed-entry fields ------------------------------------------------------------------

def content_coalesce(content: str, description: str, summary: str, detail: str) -> str:
    return (f"(CASE WHEN coalesce(size({content}), 0) > 0 THEN coalesce(get({content}, 0).value, '') "
            f"ELSE coalesce(nullif({description}, ''), nullif({summary}, ''), nullif({detail}, ''), '') END)")


def entry_categories(tags: str, category: str) -> str:
    return (f"(CASE WHEN coalesce(size({tags}), 0) > 0 THEN transform({tags}, t -> t.term) "
            f"ELSE coalesce({category}, CAST(array() AS ARRAY<STRING>)) END)")


def entry_tags(tags: str, categories: str) -> str:
    picked = (f"filter(transform(coalesce({tags}, CAST(array() AS ARRAY<STRUCT<term: STRING, label: STRING>>)), "
              f"t -> coalesce(nullif(t.term, ''), nullif(t.label, ''))), v -> v IS NOT NULL)")
    return (f"(CASE WHEN size({picked}) > 0 THEN {picked} "
            f"ELSE coalesce({categories}, CAST(array() AS ARRAY<STRING>)) END)")


def entry_author(author: str, detail_name: str) -> str:
    return f"coalesce(nullif({author}, ''), {detail_name}, '')"


# --- vectors --------------------------------------------------------------------------------

def dot(a: str, b: str) -> str:
    return (f"aggregate(zip_with(CAST({a} AS ARRAY<DOUBLE>), CAST({b} AS ARRAY<DOUBLE>), (x, y) -> x * y), "
            f"CAST(0 AS DOUBLE), (acc, x) -> acc + x)")


def norm(v: str) -> str:
    return f"sqrt(aggregate(CAST({v} AS ARRAY<DOUBLE>), CAST(0 AS DOUBLE), (acc, x) -> acc + x * x))"


def cosine_similarity(a: str, b: str) -> str:
    return f"try_divide({dot(a, b)}, {norm(a)} * {norm(b)})"
