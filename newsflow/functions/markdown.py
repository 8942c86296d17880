"""HTML to Markdown as one JVM expression: a fold over the tags with an explicit state.

The text is cut before each tag; ``aggregate`` carries the state over the pieces: what is
open (lists with their counters, quotes, preformatted text, a table row), the line breaks
that are due before the next text, and the output so far. A tag may first ask for line
breaks, then puts its mark; the piece's text follows. The rules are those of the Markdown
converter's documentation for links and images left out and lines not wrapped:

* paragraphs, headings (``#``), quotes (``> `` on each line), rules (``* * *``) and
  preformatted text (indented) stand between blank lines, ``<br>`` is two spaces and a break;
* list items begin a line with two spaces for each open list and ``* `` or their number
  (``start`` sets the first); lists inside lists go on without a blank line;
* cells of a row are parted by ``| ``, the first row of a table is underlined;
* ``_`` for emphasis, ``**`` for strong, ``~~`` for deleted text, ````` for code, with a
  space before an opening mark that follows a word, and none inside;
* what would read as a list item at the start of a line gets a backslash; the contents of
  ``head`` are left out.

Not done: explanations of abbreviations, and repair of tags that are not closed.
"""

from __future__ import annotations

from . import sql as S

BLOCKS = ("p", "div", "blockquote", "pre", "hr", "h1", "h2", "h3", "h4", "h5", "h6")
EMPHASIS = {"em": "_", "i": "_", "u": "_", "strong": "**", "b": "**", "del": "~~", "strike": "~~", "s": "~~"}
CODE = ("code", "tt", "kbd")

FIELDS = {  # name: first value
    "out": "CAST(array() AS ARRAY<STRING>)", "due": "0", "trail": "''", "fresh": "true", "gap": "false", "ended": "false", "quote": "0", "pre": "false", "prestart": "false",
    "code": "false", "quiet": "0", "lists": "CAST(array() AS ARRAY<INT>)", "waslist": "false", "cells": "0", "inrow": "false", "table": "false", "word": "false",
    "opened": "false", "closed": "false",
}


def _is(*names: str) -> str:
    return "t.name IN (" + ", ".join(S.lit(n) for n in names) + ")"


def _new(s: str, **fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{f}', {fields.get(f, f'{s}.{f}')}" for f in FIELDS) + ")"


def _bind(x: str, name: str, body: str) -> str:
    return f"transform(array({x}), {name} -> {body})[0]"


def _put(s: str, text: str, forced: str = "false", pure: bool = False) -> str:
    """State ``s`` after ``text`` was put out, with the breaks and the space that are due."""
    collapsed = S.rr(text, S.WS_CLASS + "+", " ") if pure else text
    if pure:
        collapsed = f"IF({s}.pre, {text}, {collapsed})"
    lead = f"NOT {s}.pre AND startswith(d, ' ')" if pure else "false"
    quoted = f"concat(repeat('>', {s}.quote), IF({s}.quote > 0 AND NOT ({forced}), ' ', ''))"
    margin = f"IF({s}.pre, concat({quoted}, repeat('    ', greatest(1, size({s}.lists)))), {quoted})"
    body = f"IF({s}.prestart AND NOT startswith(g.d, '\\n'), concat('\\n', g.d), g.d)"
    body = f"IF({s}.pre, replace({body}, '\\n', concat('\\n', {margin})), {body})"
    body = f"IF({s}.prestart AND size({s}.lists) > 0, ltrim('\\n', {body}), {body})"
    before = f"IF({s}.fresh, '', IF({s}.due > 0, repeat(concat({s}.trail, '\\n', {margin}), {s}.due), IF(g.gap AND NOT {s}.ended, ' ', '')))"
    done = _new(s, out=f"array_append({s}.out, concat({before}, {body}))", due="0", trail=f"IF({s}.due > 0 AND NOT {s}.fresh, '', {s}.trail)", fresh="false", gap="false",
                ended="endswith(g.d, '\\n')", prestart="false")
    kept = f"CASE WHEN {s}.quiet > 0 THEN {s} WHEN g.d = '' AND NOT ({forced}) THEN {_new(s, gap='g.gap')} ELSE {done} END"
    return _bind(collapsed, "d", _bind(f"named_struct('d', IF({lead}, substring(d, 2), d), 'gap', {s}.gap OR {lead})", "g", kept))


def _before() -> str:
    """The state after the tag has asked for line breaks, and opened or closed what it opens or closes."""
    line = f"({_is('li')} OR ({_is('tr', 'dt', 'dd')} AND t.close))"
    block = f"({_is(*BLOCKS)} OR ({_is('dl')} AND NOT t.close) OR ({_is('ul', 'ol')} AND NOT t.close AND size(s.lists) = 0 AND NOT s.waslist))"
    last = "element_at(s.lists, -1)"
    lists = (f"CASE WHEN {_is('ul')} AND NOT t.close THEN array_append(s.lists, -1) WHEN {_is('ol')} AND NOT t.close THEN array_append(s.lists, t.first - 1) "
             f"WHEN {_is('ul', 'ol')} AND size(s.lists) > 0 THEN slice(s.lists, 1, size(s.lists) - 1) "
             f"WHEN {_is('li')} AND NOT t.close AND size(s.lists) > 0 AND {last} >= 0 THEN array_append(slice(s.lists, 1, size(s.lists) - 1), {last} + 1) ELSE s.lists END")
    return _new("s", due=f"CASE WHEN {block} THEN greatest(s.due, 2) WHEN {line} THEN greatest(s.due, 1) ELSE s.due END",
                trail=f"IF({_is('tr')} AND t.close, '  ', s.trail)", lists=lists, waslist=f"{_is('ul', 'ol')} AND t.close",
                quote=f"IF({_is('blockquote')} AND t.close, greatest(0, s.quote - 1), s.quote)",
                pre=f"IF({_is('pre')}, NOT t.close, s.pre)", prestart=f"IF({_is('pre')}, NOT t.close, s.prestart)",
                quiet=f"CASE WHEN {_is('head')} THEN greatest(0, s.quiet + IF(t.close, -1, 1)) WHEN {_is('body')} AND NOT t.close THEN 0 ELSE s.quiet END",
                table=f"IF({_is('table')}, NOT t.close, s.table)", cells=f"IF({_is('tr')} AND NOT t.close, 0, s.cells)")


def _mark() -> str:
    number = "element_at(s.lists, -1)"
    item = f"concat(repeat('  ', size(s.lists)), IF(size(s.lists) = 0 OR {number} < 0, '* ', concat({number}, '. ')))"
    emphasis = "CASE t.name " + " ".join(f"WHEN {S.lit(n)} THEN {S.lit(m)}" for n, m in EMPHASIS.items()) + " END"
    return (f"CASE WHEN t.name RLIKE '^h[1-6]$' AND NOT t.close THEN concat(repeat('#', CAST(substring(t.name, 2) AS INT)), ' ') "
            f"WHEN {_is('br')} AND NOT t.close THEN concat('  \\n', IF(s.quote > 0, '> ', '')) WHEN {_is('hr')} AND NOT t.close THEN '* * *' "
            f"WHEN {_is('blockquote')} AND NOT t.close THEN '> ' WHEN {_is('li')} AND NOT t.close THEN {item} WHEN {_is('dd')} AND NOT t.close THEN '    ' "
            f"WHEN {_is('td', 'th')} AND NOT t.close AND s.inrow THEN '| ' WHEN {_is('tr')} AND t.close AND s.table THEN array_join(array_repeat('---', s.cells), '|') "
            f"WHEN {_is('ul', 'ol')} AND t.close AND size(s.lists) = 0 THEN '\\n' WHEN {_is(*EMPHASIS)} THEN concat(IF(NOT t.close AND s.word, ' ', ''), {emphasis}) "
            f"WHEN {_is(*CODE)} AND NOT s.pre THEN '`' WHEN {_is('q')} THEN '\"' ELSE '' END")


def _after() -> str:
    """The state after the mark."""
    starts = f"({_is('li', 'blockquote')} AND NOT t.close)"
    ruled = f"({_is('tr')} AND t.close AND s.table)"
    opens = f"({_is(*EMPHASIS)} AND NOT t.close)"
    return _new("s", fresh=f"s.fresh OR {starts}", quote=f"IF({_is('blockquote')} AND NOT t.close, s.quote + 1, s.quote)",
                due=f"CASE WHEN {_is('hr')} THEN 2 WHEN {ruled} THEN 1 ELSE s.due END", trail=f"IF({ruled}, '  ', s.trail)",
                table=f"s.table AND NOT {ruled}", inrow=f"CASE WHEN {_is('td', 'th')} AND NOT t.close THEN true WHEN {_is('tr')} AND t.close THEN false ELSE s.inrow END",
                cells=f"IF({_is('td', 'th')} AND NOT t.close, s.cells + 1, s.cells)", code=f"IF({_is(*CODE)} AND NOT s.pre, NOT s.code, s.code)",
                opened=f"s.opened OR {opens}", word=f"s.word AND NOT {opens}")


def _text() -> str:
    """The state after the piece's text."""
    spaced = f"IF(s.closed AND NOT s.pre AND NOT s.code AND NOT (t.text RLIKE {S.lit('^(' + S.WS_CLASS + '|[.!?])')}), concat(' ', t.text), t.text)"
    raw = f"IF(s.opened, {S.strip('t.text')}, {spaced})"
    escaped = f"regexp_replace(x, {S.lit('(?m)^(' + S.WS_CLASS + '*[0-9]+)[.](?=' + S.WS_CLASS + ')')}, {S.lit(chr(36) + '1' + chr(92) * 2 + '.')})"
    for sign, ahead in (("[+]", S.WS_CLASS), ("-", f"({S.WS_CLASS}|-)")):
        escaped = f"regexp_replace({escaped}, {S.lit('(?m)^(' + S.WS_CLASS + '*)' + sign + '(?=' + ahead + ')')}, {S.lit(chr(36) + '1' + chr(92) * 2 + sign.strip('[]'))})"
    told = _new("s", opened="false", closed="s.opened", word=f"IF(x = '', s.word, NOT (x RLIKE {S.lit(S.WS_CLASS + '$')}))")
    put = _bind(f"IF(s.code OR s.pre, x, {escaped})", "y", _bind(told, "s", _put("s", "y", pure=True)))
    return f"IF(t.text = '', s, {_bind(raw, 'x', put)})"


def to_markdown(html: str) -> str:
    """The Markdown text of ``html`` (without scripts, styles and comments), not yet cleaned of white space."""
    pieces = f"split({html}, '<(?=[a-zA-Z/!?])', -1)"
    name = r"lower(regexp_extract(w, '^/?([a-zA-Z][a-zA-Z0-9]*)[^>]*>', 1))"
    tag = "w RLIKE '^[^>]*>'"
    text = f"IF(j = 0, w, IF({tag}, substring(w, locate('>', w) + 1), concat('<', w)))"
    first = r"coalesce(try_cast(nullif(regexp_extract(w, '(?i)^ol[^>]* start\\s*=\\s*[\'\"]?([0-9]{1,8})', 1), '') AS INT), 1)"
    piece = f"named_struct('name', IF(j = 0, '', {name}), 'close', j > 0 AND startswith(w, '/'), 'first', {first}, 'text', {S.decode_entities(text)})"
    begin = "named_struct(" + ", ".join(f"'{f}', {v}" for f, v in FIELDS.items()) + ")"
    marked = _bind(_mark(), "m", f"IF(m = '', s, {_put('s', 'm', forced=_is('blockquote'))})")
    step = f"IF(t.name = '', {_text()}, {_bind(_before(), 's', _bind(marked, 's', _bind(_after(), 's', _text())))})"
    return f"array_join(aggregate(transform({pieces}, (w, j) -> {piece}), {begin}, (s, t) -> {step}).out, '')"
