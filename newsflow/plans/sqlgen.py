"""DuckDB SQL for the correctness oracle.

Each builder returns a DuckDB SQL *expression* with the same semantics as the
Spark column function of the same name, written independently in DuckDB's
dialect (RE2 regexes with the ``'g'`` flag, 1-based lists, ``list_*``
functions). No pattern of the implementation is imported, only knobs and the
prompt and topic texts that both sides must share.
"""

from __future__ import annotations

from .. import config as C


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def lit_text(s: str) -> str:
    """SQL text literal that may contain newlines (built with chr(10))."""
    parts = s.split("\n")
    return " || chr(10) || ".join(q(p) for p in parts) if len(parts) > 1 else q(s)


def _spaces() -> str:
    """The characters that ``str.isspace`` knows, as a class."""
    return "[" + "".join(f"{chr(92)}x{{{n:x}}}" for n in range(0x10000) if chr(n).isspace()) + "]"


WS = _spaces()
SCRIPTS = r"(?is)<(?:script|style)(?:[\s/][^>]*)?>.*?</(?:script|style)\s*>"
COMMENTS = r"(?s)<!--.*?-->"
SCHEME = r"^[A-Za-z][A-Za-z0-9.+-]*://"
NETLOC = r"^(?:[A-Za-z][A-Za-z0-9.+-]*:)?//([^/?#]*)"
RUNS = r"([\p{L}]+|[^\p{L}]+)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def collapse_ws(x: str) -> str:
    return f"trim(regexp_replace({x}, {q(WS + '+')}, ' ', 'g'))"


def words(x: str) -> str:
    return f"list_filter(string_split({collapse_ws('coalesce(' + x + ", '')")}, ' '), lambda w: w <> '')"


def word_count(x: str) -> str:
    return f"len({words(x)})::BIGINT"


def truncate_ellipsis(x: str, n: int) -> str:
    return f"(CASE WHEN length({x}) > {n} THEN left({x}, {n}) || '...' ELSE {x} END)"


def nullif_empty(x: str) -> str:
    return f"nullif({x}, '')"


def decode_entities(x: str) -> str:
    """Character references by the standard's rules, over a copy of the public table of this module's own."""
    from html.entities import html5 as public
    names = "MAP {" + ", ".join(f"{lit_any(k)}: {lit_any(v)}" for k, v in public.items()) + "}"
    bare = "|".join(sorted((k for k in public if k[-1] != ";"), key=len, reverse=True))
    whole = "regexp_extract(p, '^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)', 1)"
    digits = f"ltrim(rtrim(ltrim({whole}, '#xX'), ';'), '0')"
    is_hex = f"regexp_matches({whole}, '^#[xX]')"
    num = (f"(CASE WHEN length({digits}) > 7 THEN 9999999 WHEN {digits} = '' THEN 0 WHEN {is_hex} THEN CAST('0x' || {digits} AS BIGINT) "
           f"ELSE CAST({digits} AS BIGINT) END)")
    c1 = " ".join(f"WHEN {n} THEN {lit_any(bytes([n]).decode('cp1252', 'ignore') or chr(n))}" for n in range(128, 160))
    char = (f"(CASE {num} WHEN 0 THEN chr(65533) WHEN 13 THEN chr(13) {c1} ELSE CASE WHEN {num} > 1114111 OR ({num} >= 55296 AND {num} <= 57343) THEN chr(65533) "
            f"WHEN {num} < 9 OR {num} = 11 OR ({num} > 13 AND {num} < 32) OR {num} = 127 OR ({num} >= 64976 AND {num} < 65008) OR {num} % 65536 >= 65534 THEN '' "
            f"ELSE chr(CAST({num} AS INTEGER)) END END)")
    first = f"regexp_extract({whole}, '^(' || {q(bare)} || ')', 1)"
    piece = (f"CASE WHEN i = 1 THEN p WHEN {whole} = '' THEN '&' || p WHEN starts_with({whole}, '#') THEN {char} || substr(p, length({whole}) + 1) "
             f"WHEN map_contains({names}, {whole}) THEN {names}[{whole}] || substr(p, length({whole}) + 1) "
             f"WHEN {first} <> '' THEN {names}[{first}] || substr(p, length({first}) + 1) ELSE '&' || p END")
    return f"array_to_string(list_transform(string_split({x}, '&'), lambda p, i: {piece}), '')"


def lit_any(s: str) -> str:
    """SQL text literal of any characters."""
    return "(" + " || ".join(q(c) if ord(c) >= 32 and ord(c) != 127 else f"chr({ord(c)})" for c in s) + ")" if any(ord(c) < 32 or ord(c) == 127 for c in s) else q(s)


def clean_html(x: str) -> str:
    e = f"coalesce({x}, '')"
    e = f"regexp_replace({e}, {q(SCRIPTS)}, ' ', 'g')"
    e = f"regexp_replace({e}, {q(COMMENTS)}, ' ', 'g')"
    e = f"regexp_replace({e}, {q('</?[A-Za-z!?/][^>]*>')}, ' ', 'g')"
    return collapse_ws(decode_entities(e))


NL = "chr(10)"


def _let(name: str, x: str, body: str) -> str:
    return f"(list_transform([{x}], lambda {name}: {body}))[1]"


def markdown(x: str) -> str:
    """The Markdown converter's rules as a fold over the tags (links and images ignored, lines not wrapped).

    ``a`` is the state: text ``o``, breaks due ``p``, blanks at their ends ``b``, nothing yet on the line ``f``, a space due ``g``,
    quotes ``q``, preformatted ``k`` and its beginning ``k1``, code ``c``, left out ``h``, lists ``l`` (0 and up: a counter), a list just
    closed ``lc``, cells ``n``, in a row ``r``, first row ``t``, after a word ``w``, emphasis just opened ``e``, its text just ended ``z``.
    ``u`` is a piece: tag name ``v``, closing ``x``, number ``s`` of the first item, text ``d``."""
    keys = "o p b f g q k k1 c h l lc n r t w e z".split()

    def upd(a: str, **new: str) -> str:
        return "{" + ", ".join(f"'{k}': {new.get(k, f'{a}.{k}')}" for k in keys) + "}"

    def among(*names: str) -> str:
        return f"list_contains([{', '.join(q(n) for n in names)}], u.v)"
    nl = "chr(10)"
    edge = "repeat('>', a.q)"

    def write(d: str, force: str) -> str:
        """The state after the non-empty text ``d``."""
        side = f"({edge} || CASE WHEN a.q > 0 AND NOT {force} THEN ' ' ELSE '' END || CASE WHEN a.k THEN repeat('    ', greatest(1, len(a.l))) ELSE '' END)"
        body = f"(CASE WHEN a.k THEN replace((CASE WHEN a.k1 AND NOT starts_with({d}, {nl}) THEN {nl} ELSE '' END) || {d}, {nl}, {nl} || {side}) ELSE {d} END)"
        body = f"(CASE WHEN a.k1 AND len(a.l) > 0 THEN ltrim({body}, {nl}) ELSE {body} END)"
        lead = f"(CASE WHEN a.f THEN '' WHEN a.p > 0 THEN repeat(a.b || {nl} || {side}, a.p) WHEN a.g AND NOT ends_with(a.o, {nl}) THEN ' ' ELSE '' END)"
        return upd("a", o=f"a.o || {lead} || {body}", p="0", b="(CASE WHEN a.p > 0 AND NOT a.f THEN '' ELSE a.b END)", f="false", g="false", k1="false")
    open_, shut = "NOT u.x", "u.x"
    emph = {"em": "_", "i": "_", "u": "_", "strong": "**", "b": "**", "del": "~~", "strike": "~~", "s": "~~"}
    code = among("code", "tt", "kbd")
    two = (f"({among('p', 'div', 'h1', 'h2', 'h3', 'h4', 'h5', 'h6', 'hr', 'pre', 'blockquote')} OR (u.v = 'dl' AND {open_}) "
           f"OR ({among('ul', 'ol')} AND {open_} AND len(a.l) = 0 AND NOT a.lc))")
    one = f"(u.v = 'li' OR ({among('tr', 'dt', 'dd')} AND {shut}))"
    lists = (f"(CASE WHEN u.v = 'ul' AND {open_} THEN list_append(a.l, -1) WHEN u.v = 'ol' AND {open_} THEN list_append(a.l, u.s - 1) WHEN {among('ul', 'ol')} THEN a.l[1:greatest(len(a.l) - 1, 0)] "
             f"WHEN u.v = 'li' AND {open_} AND len(a.l) > 0 AND a.l[len(a.l)] >= 0 THEN list_append(a.l[1:len(a.l) - 1], a.l[len(a.l)] + 1) ELSE a.l END)")
    asked = upd("a", p=f"(CASE WHEN {two} THEN 2 WHEN {one} THEN greatest(a.p, 1) ELSE a.p END)", b=f"(CASE WHEN u.v = 'tr' AND {shut} THEN '  ' ELSE a.b END)", l=lists,
                lc=f"({among('ul', 'ol')} AND {shut})", q=f"(CASE WHEN u.v = 'blockquote' AND {shut} THEN greatest(a.q - 1, 0) ELSE a.q END)",
                k=f"(CASE WHEN u.v = 'pre' THEN {open_} ELSE a.k END)", k1=f"(CASE WHEN u.v = 'pre' THEN {open_} ELSE a.k1 END)",
                h=f"(CASE WHEN u.v = 'head' THEN greatest(a.h + CASE WHEN {shut} THEN -1 ELSE 1 END, 0) WHEN u.v = 'body' AND {open_} THEN 0 ELSE a.h END)",
                t=f"(CASE WHEN u.v = 'table' THEN {open_} ELSE a.t END)", n=f"(CASE WHEN u.v = 'tr' AND {open_} THEN 0 ELSE a.n END)")
    marks = "CASE u.v " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in emph.items()) + " END"
    mark = (f"(CASE WHEN {among('h1', 'h2', 'h3', 'h4', 'h5', 'h6')} AND {open_} THEN repeat('#', CAST(u.v[2] AS INTEGER)) || ' ' "
            f"WHEN u.v = 'br' AND {open_} THEN '  ' || {nl} || CASE WHEN a.q > 0 THEN '> ' ELSE '' END WHEN u.v = 'hr' AND {open_} THEN '* * *' WHEN u.v = 'blockquote' AND {open_} THEN '> ' "
            f"WHEN u.v = 'li' AND {open_} THEN repeat('  ', len(a.l)) || CASE WHEN len(a.l) > 0 AND a.l[len(a.l)] >= 0 THEN a.l[len(a.l)] || '. ' ELSE '* ' END "
            f"WHEN u.v = 'dd' AND {open_} THEN '    ' WHEN {among('td', 'th')} AND {open_} AND a.r THEN '| ' WHEN u.v = 'tr' AND {shut} AND a.t THEN rtrim(repeat('---|', a.n), '|') "
            f"WHEN {among('ul', 'ol')} AND {shut} AND len(a.l) = 0 THEN {nl} WHEN {among(*emph)} THEN CASE WHEN {open_} AND a.w THEN ' ' ELSE '' END || {marks} "
            f"WHEN {code} AND NOT a.k THEN chr(96) WHEN u.v = 'q' THEN chr(34) ELSE '' END)")
    ruled, begun = f"(u.v = 'tr' AND {shut} AND a.t)", f"({among(*emph)} AND {open_})"
    settled = upd("a", f=f"(a.f OR ({among('li', 'blockquote')} AND {open_}))", q=f"(a.q + CASE WHEN u.v = 'blockquote' AND {open_} THEN 1 ELSE 0 END)",
                  p=f"(CASE WHEN u.v = 'hr' THEN 2 WHEN {ruled} THEN 1 ELSE a.p END)", b=f"(CASE WHEN {ruled} THEN '  ' ELSE a.b END)", t=f"(a.t AND NOT {ruled})",
                  r=f"((a.r OR ({among('td', 'th')} AND {open_})) AND NOT (u.v = 'tr' AND {shut}))", n=f"(a.n + CASE WHEN {among('td', 'th')} AND {open_} THEN 1 ELSE 0 END)",
                  c=f"(CASE WHEN {code} AND NOT a.k THEN NOT a.c ELSE a.c END)", e=f"(a.e OR {begun})", w=f"(a.w AND NOT {begun})")
    space = f"regexp_matches(u.d, {q('^(' + WS + '|[.!?])')})"
    shown = f"(CASE WHEN a.e THEN {strip('u.d')} WHEN a.z AND NOT a.k AND NOT a.c AND NOT {space} THEN ' ' || u.d ELSE u.d END)"
    bs = chr(92)
    safe = f"regexp_replace(y, {q('(?m)^(' + WS + '*[0-9]+)[.](' + WS + ')')}, {q(bs + '1' + bs * 2 + '.' + bs + '2')}, 'g')"
    safe = f"regexp_replace({safe}, {q('(?m)^(' + WS + '*)[+](' + WS + ')')}, {q(bs + '1' + bs * 2 + '+' + bs + '2')}, 'g')"
    safe = f"regexp_replace({safe}, {q('(?m)^(' + WS + '*)-(' + WS + '|-)')}, {q(bs + '1' + bs * 2 + '-' + bs + '2')}, 'g')"
    told = upd("a", e="false", z="a.e", w=f"(CASE WHEN y = '' THEN a.w ELSE NOT regexp_matches(y, {q(WS + '$')}) END)")
    joined = f"(CASE WHEN a.k THEN y ELSE regexp_replace(CASE WHEN a.c THEN y ELSE {safe} END, {q(WS + '+')}, ' ', 'g') END)"
    flow = _let("y", joined, _let("a", upd("a", g="(a.g OR (NOT a.k AND starts_with(y, ' ')))"), _let(
        "y", "(CASE WHEN NOT a.k AND starts_with(y, ' ') THEN substr(y, 2) ELSE y END)", f"CASE WHEN y = '' THEN a ELSE {write('y', 'false')} END")))
    said = f"(CASE WHEN u.d = '' THEN a ELSE {_let('y', shown, _let('z', told, f'CASE WHEN a.h > 0 THEN z ELSE {_let(chr(97), chr(122), flow)} END'))} END)"
    marked = f"(CASE WHEN m = '' OR a.h > 0 THEN a ELSE {write('m', '(u.v = ' + q('blockquote') + ')')} END)"
    step = _let("a", asked, _let("a", _let("m", mark, marked), _let("a", settled, said)))
    begin = ("{'o': '', 'p': 0, 'b': '', 'f': true, 'g': false, 'q': 0, 'k': false, 'k1': false, 'c': false, 'h': 0, 'l': []::INTEGER[], 'lc': false, 'n': 0, 'r': false, 't': false, "
             "'w': false, 'e': false, 'z': false}")
    cut = f"string_split(regexp_replace({x}, '<([a-zA-Z/!?])', chr(1) || '{bs}1', 'g'), chr(1))"
    tag = "j > 1 AND regexp_matches(i, '^[^>]*>')"
    name = f"CASE WHEN j > 1 THEN lower(regexp_extract(i, '^/?([a-zA-Z][a-zA-Z0-9]*)[^>]*>', 1)) ELSE '' END"
    number = f"coalesce(try_cast(regexp_extract(i, {q('(?i)^ol[^>]* start' + bs + 's*=' + bs + 's*[' + chr(34) + chr(39) + ']?([0-9]{1,8})')}, 1) AS INTEGER), 1)"
    text = f"CASE WHEN j = 1 THEN i WHEN {tag} THEN substr(i, instr(i, '>') + 1) ELSE '<' || i END"
    pieces = f"list_transform({cut}, lambda i, j: {{'v': {name}, 'x': j > 1 AND starts_with(i, '/'), 's': {number}, 'd': {decode_entities('(' + text + ')')}}})"
    return f"(list_reduce({pieces}, lambda a, u: {step}, {begin})).o"


def clean_content(x: str) -> str:
    e = f"regexp_replace({x}, {q(SCRIPTS)}, '', 'g')"
    e = f"regexp_replace({e}, {q(COMMENTS)}, '', 'g')"
    e = markdown(e)
    e = f"regexp_replace({e}, {q(chr(92) + 'n' + WS + '*' + chr(92) + 'n')}, {NL} || {NL}, 'g')"
    e = f"regexp_replace({e}, {q('[ ' + chr(92) + 't]+')}, ' ', 'g')"
    e = strip(e)
    return f"(CASE WHEN {x} IS NULL OR {x} = '' THEN {x} ELSE {e} END)"


def title_case(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, {q(RUNS)}, 1), "
            f"lambda w: (CASE WHEN left(w, 1) = 'ß' THEN 'Ss' ELSE upper(left(w, 1)) END) || lower(substr(w, 2))), '')")


def slug(x: str) -> str:
    e = f"replace(lower(coalesce({x}, '')), ' ', '-')"
    e = f"replace(replace({e}, '''', ''), '\"', '')"
    e = f"regexp_replace({e}, '[^a-z0-9\\-]', '', 'g')"
    e = f"regexp_replace({e}, '-+', '-', 'g')"
    return f"regexp_replace({e}, '^-+|-+$', '', 'g')"


def url_authority(x: str) -> str:
    return f"regexp_extract(coalesce({x}, ''), {q(NETLOC)}, 1)"


def source_name(x: str) -> str:
    h = f"lower({url_authority(x)})"
    h = f"(CASE WHEN starts_with({h}, 'www.') THEN substr({h}, 5) ELSE {h} END)"
    return title_case(f"string_split({h}, '.')[1]")


def md5_of(*xs: str) -> str:
    return "md5(" + " || ".join(f"coalesce({x}, '')" for x in xs) + ")"


def article_id(title: str, link: str, name: str) -> str:
    return f"coalesce(nullif({name}, ''), 'unknown') || '_' || {md5_of(title, link)}"


def _id_safe(x: str) -> str:
    return f"regexp_replace({x}, '[^a-zA-Z0-9_]', '_', 'g')"


def processor_source(feed: str) -> str:
    f = f"coalesce({feed}, 'unknown')"
    host = f"string_split(coalesce(string_split({f}, '://')[2], ''), '/')[1]"
    from_url = f"replace(replace(replace({host}, 'www.', ''), '.com', ''), '.', '_')"
    last = f"string_split({f}, '/')[-1]"
    from_path = f"replace(replace(replace({last}, '.xml', ''), '.rss', ''), '.', '_')"
    name = _id_safe(f"(CASE WHEN contains({f}, '://') THEN {from_url} ELSE {from_path} END)")
    return f"(CASE WHEN {f} = 'unknown' OR {name} = '' OR {name} = '_' THEN 'unknown' ELSE {name} END)"


def processor_id(title: str, url: str, feed: str) -> str:
    return f"{processor_source(feed)} || '_' || {md5_of(title, url)}"


def api_source(feed: str) -> str:
    f = f"coalesce({feed}, 'unknown')"
    last = f"string_split({f}, '/')[-1]"
    return _id_safe(f"replace(replace(replace({last}, '.xml', ''), '.rss', ''), '.', '_')")


def api_id(title: str, url: str, feed: str) -> str:
    return f"{api_source(feed)} || '_' || {md5_of(title, url)}"


def iso_text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S')"


def display_date(x: str) -> str:
    ts = f"try_cast({x} AS TIMESTAMP)"
    return (f"(CASE WHEN {x} IS NULL OR {x} = '' THEN {q(C.UNKNOWN_DATE_TEXT)} "
            f"WHEN {ts} IS NULL THEN {q(C.INVALID_DATE_TEXT)} ELSE strftime({ts}, '%b %-d, %Y') END)")


def display_source(x: str) -> str:
    plain = f"upper(left({x}, 1)) || substr({x}, 2)"
    auth = f"regexp_extract({x}, {q(NETLOC)}, 1)"
    host = f"lower(regexp_replace(regexp_replace({auth}, '^.*@', ''), ':[0-9]*$', ''))"
    for part in ("www.", ".com", ".org", ".net"):
        host = f"regexp_replace({host}, {q(part.replace('.', chr(92) + '.'))}, '')"   # first hit only
    last = f"replace(replace(string_split({x}, '/')[-1], '.xml', ''), '.rss', '')"
    return (f"(CASE WHEN {x} IS NULL OR {x} = '' THEN {q(C.UNKNOWN_SOURCE_TEXT)} "
            f"WHEN NOT contains({x}, 'http') AND NOT contains({x}, '/') THEN {plain} "
            f"WHEN regexp_matches({x}, {q(SCHEME)}) THEN {host} "
            f"WHEN {last} = '' THEN {q(C.UNKNOWN_SOURCE_TEXT)} ELSE {last} END)")


def embedding_text(title: str, summary: str, content: str, limit: int | None = C.EMBED_TEXT_CHARS) -> str:
    t = (f"('Title: ' || coalesce({title}, '') || chr(10) || chr(10) || 'Summary: ' || coalesce({summary}, '') "
         f"|| chr(10) || chr(10) || 'Content: ' || coalesce({content}, ''))")
    return t if limit is None else truncate_ellipsis(t, limit)


def lead_words(x: str, n: int = C.SUMMARY_WORDS) -> str:
    return f"array_to_string({words(x)}[1:{n}], ' ')"


def tokens(x: str) -> str:
    return (f"list_filter(string_split(trim(regexp_replace(lower(coalesce({x}, '')), '[^a-z]+', ' ', 'g')), ' '), "
            f"lambda w: w <> '')")


def hash_bucket(w: str, dim: int = C.EMBED_DIM) -> str:
    return f"((('0x' || substr(md5({w}), 1, 8))::BIGINT) % {dim})"


def parse_batch_response(x: str, n: str) -> str:
    parts = f"string_split(coalesce({x}, ''), {q(C.SUMMARY_SEPARATOR)})"
    kept = f"list_filter(list_transform({parts}, lambda p: {strip('p')}), lambda p: p <> '')"
    return f"list_concat({kept}, list_transform(range({n}), lambda i: ''))[1:{n}]"


def rfc822_sql(ts: str) -> str:
    return f"strftime({ts}, '%a, %d %b %Y %H:%M:%S') || ' GMT'"


# --- shared CTEs over the driver tables -------------------------------------------------------

FEED_RE = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/)([^/?#]*)"
LINK_RE = r'<a href="/([^"]*)">([^<]*)</a>'


def entries_cte() -> str:
    return f"""entries AS (
  SELECT page_id,
    regexp_extract(url, {q(FEED_RE)}, 1) || regexp_extract(url, {q(FEED_RE)}, 2) || '/' AS feed_url,
    regexp_extract(url, {q(FEED_RE)}, 2) AS feed_category,
    page_id AS entry_pos,
    regexp_extract(html, {q('(?is)<title[^>]*>(.*?)</title>')}, 1) AS title,
    url AS link,
    regexp_extract(html, {q('(?is)<p(?:' + chr(92) + 's[^>]*)?>(.*?)</p>')}, 1) AS summary,
    regexp_extract(html, {q('(?is)<div class="ad">(.*?)</div>')}, 1) AS description,
    regexp_extract(html, {q('(?is)<article[^>]*>(.*?)</article>')}, 1) AS article_html,
    regexp_extract(html, {q('(?is)<footer[^>]*>(.*?)</footer>')}, 1) AS footer,
    regexp_extract_all(html, {q(LINK_RE)}, 1) AS tag_terms,
    regexp_extract_all(html, {q(LINK_RE)}, 2) AS tag_labels,
    regexp_extract(html, {q('<meta name="author" content="([^"]*)"')}, 1) AS author,
    lower({url_authority('url')}) AS author_name,
    {rfc822_sql("TIMESTAMP '2024-01-01 00:00:00' + page_id * INTERVAL 1 HOUR")} AS published
  FROM pages)"""


def articles_cte(run_ts: str = C.DEFAULT_RUN_TS) -> str:
    """RAW_ARTICLE rows (parse_entry) from ``entries``."""
    content = (f"(CASE WHEN article_html <> '' THEN article_html ELSE coalesce(nullif(description, ''), "
               f"nullif(summary, ''), nullif(footer, ''), '') END)")
    cats = "(CASE WHEN len(tag_terms) > 0 THEN tag_terms ELSE [feed_category] END)"
    picked = ("list_filter(list_transform(range(1, len(tag_terms) + 1), "
              "lambda i: coalesce(nullif(tag_terms[i], ''), nullif(tag_labels[i], ''))), lambda v: v IS NOT NULL)")
    no_wd = f"regexp_replace(published, {q('^[A-Za-z]{3},' + chr(92) + 's*')}, '')"
    date = f"coalesce({iso_text(f'try_strptime({no_wd}, {q(chr(37) + 'd %b %Y %H:%M:%S GMT')})')}, {q(run_ts)})"
    return f"""{entries_cte()},
articles AS (
  SELECT page_id, entry_pos,
    {article_id('title', 'link', source_name('feed_url'))} AS id,
    coalesce(title, '') AS title,
    coalesce(link, '') AS url,
    {clean_html('summary')} AS summary,
    {clean_html(content)} AS content,
    {date} AS date,
    coalesce(nullif(author, ''), author_name, '') AS author,
    {slug('title')} AS slug,
    {cats} AS categories,
    (CASE WHEN len({picked}) > 0 THEN {picked} ELSE {cats} END) AS tags,
    feed_url AS source_feed,
    {source_name('feed_url')} AS source_name,
    coalesce(feed_category, 'general') AS category,
    {q(run_ts)} AS fetched_at
  FROM entries)"""


def processed_cte() -> str:
    return f"""{articles_cte()},
processed AS (
  SELECT page_id, entry_pos,
    {processor_id('title', 'url', 'source_feed')} AS id,
    {strip("coalesce(title, '')")} AS title,
    {clean_content('content')} AS content,
    url, date, author, slug, categories, tags, source_feed
  FROM articles)"""


def vectors_cte(run_ts: str = C.DEFAULT_RUN_TS, caps: bool = False) -> str:
    """vector_records: embeddings + metadata of the article with page_id = vec_id."""
    title, summary, tags = ("title", "summary", "tags") if not caps else (
        f"left(title, {C.TITLE_CAP})", f"left(summary, {C.SUMMARY_CAP})", f"tags[1:{C.TAGS_CAP}]")
    return f"""{articles_cte(run_ts)},
meta AS (
  SELECT page_id,
    {title} AS title, url AS link, {summary} AS summary,
    date AS published, source_name, {tags} AS tags,
    left({embedding_text('title', 'summary', 'content')}, {C.PREVIEW_CHARS}) AS content_preview
  FROM articles),
vectors AS (
  SELECT e.vec_id AS id, e.embedding::DOUBLE[] AS embedding,
    coalesce(m.title, '') AS title, coalesce(m.link, '') AS link, coalesce(m.summary, '') AS summary,
    coalesce(m.published, '') AS published, coalesce(m.source_name, '') AS source_name,
    CAST(e.label AS VARCHAR) AS category, coalesce(m.tags, []::VARCHAR[]) AS tags,
    coalesce(m.content_preview, '') AS content_preview
  FROM embeddings e LEFT JOIN meta m ON m.page_id = e.vec_id)"""


def doc_index_cte() -> str:
    """The text index over ``documents``: title = first line (stripped),
    summary = the default summary (lead 175 words), category = lang."""
    title = strip(f"regexp_extract(text, {q('^([^' + chr(92) + 'n]*)')}, 1)")
    return f"""docs AS (
  SELECT doc_id AS id, {title} AS title, {lead_words('text')} AS summary, lang AS category,
    source AS source_name, text
  FROM documents),
doc_index AS (
  SELECT id, title, summary, category, source_name,
    {embedding_text('title', "''", 'text', None)} AS embed_text
  FROM docs)"""


def sparse_cte(name: str, src: str, id_col: str, text_col: str) -> str:
    """``{name}_w(id, b, w)`` and ``{name}_n(id, n)``: the hashed embedding."""
    return f"""{name}_t AS (SELECT {id_col} AS id, unnest({tokens(text_col)}) AS tok FROM {src}),
{name}_w AS (SELECT id, {hash_bucket('tok')} AS b, count(*)::DOUBLE AS w FROM {name}_t GROUP BY ALL),
{name}_n AS (SELECT id, sqrt(sum(w * w)) AS n FROM {name}_w GROUP BY id)"""


def text_search_cte(qsrc: str, qid: str, qtext: str, dsrc: str, did: str, dtext: str, n: int,
                    threshold: float = C.SIMILARITY_THRESHOLD, name: str = "hits") -> str:
    """``{name}(query_id, id, score, rank)``: top n docs per query by cosine."""
    return f"""{sparse_cte('qv', qsrc, qid, qtext)},
{sparse_cte('dv', dsrc, did, dtext)},
{name}_s AS (
  SELECT a.id AS query_id, b.id AS id, sum(a.w * b.w) / (qn.n * dn.n) AS score
  FROM qv_w a JOIN dv_w b ON a.b = b.b JOIN qv_n qn ON qn.id = a.id JOIN dv_n dn ON dn.id = b.id
  GROUP BY a.id, b.id, qn.n, dn.n),
{name} AS (
  SELECT * FROM (SELECT query_id, id, score,
      row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
    FROM {name}_s WHERE score >= {threshold}) WHERE rank <= {n})"""


def template(t: str, **exprs: str) -> str:
    """A ``{name}`` template as a SQL concatenation of literals and expressions."""
    import re
    out, i = [], 0
    for m in re.finditer(r"\{(\w+)\}", t):
        if m.start() > i:
            out.append(lit_text(t[i:m.start()]))
        out.append(f"CAST({exprs[m.group(1)]} AS VARCHAR)")
        i = m.end()
    if i < len(t):
        out.append(lit_text(t[i:]))
    return "(" + " || ".join(out) + ")"
