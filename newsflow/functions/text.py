"""Column functions for article text: column in, Column out.

Arguments are column names (``"title"``, ``"summary_detail.value"``), SQL
text, or Columns returned by these functions. The expressions are built as
Spark SQL text (``sql.py``) and become one ``expr`` each: built-in functions
only, evaluated on the executors; nothing here triggers a job.

Two Python behaviours that SQL built-ins get wrong by default are handled:
``str.strip()``/``str.split()`` use *Unicode* whitespace (``trim`` removes
U+0020 only) and ``str.title()`` starts a new word after any non-letter
(``initcap`` does not).
"""

from __future__ import annotations

from .. import config as C
from . import sql as S
from ._expr import col, sql_of

ISO_FMT = S.ISO_FMT


def _f(builder, *args, **kw):
    return col(builder(*[sql_of(a) for a in args], **kw))


def strip(c):
    """Python ``str.strip()``."""
    return _f(S.strip, c)


def collapse_ws(c):
    """Python ``' '.join(x.split())``."""
    return _f(S.collapse_ws, c)


def words(c):
    """Python ``x.split()`` as ARRAY<STRING> (empty text -> empty array)."""
    return _f(S.words, c)


def word_count(c):
    return _f(S.word_count, c)


def truncate_ellipsis(c, n: int):
    """``x[:n] + '...'`` when ``len(x) > n``, else ``x``."""
    return _f(S.truncate_ellipsis, c, n=n)


def nullif_empty(c):
    return _f(S.nullif_empty, c)


def decode_entities(c):
    return _f(S.decode_entities, c)


def clean_html(c):
    """Text of an HTML fragment: tags become a space, script/style/comments are
    dropped, entities decoded, whitespace collapsed. Empty/NULL -> ''."""
    return _f(S.clean_html, c)


def clean_content(c):
    """HTML -> Markdown-like text: block tags -> blank lines, headings ``#``,
    list items ``  * ``, bold ``**``, italics ``_``, other tags dropped,
    entities decoded; then ``\\n\\s*\\n`` -> blank line, ``[ \\t]+`` -> space,
    strip. NULL and '' pass through."""
    return _f(S.clean_content, c)


def html_title(html):
    return _f(S.html_title, html)


def title_case(c):
    """Python ``str.title()``."""
    return _f(S.title_case, c)


def slug(c):
    """lower, spaces -> '-', quotes dropped, [^a-z0-9-] dropped, dashes
    squeezed and trimmed."""
    return _f(S.slug, c)


def url_authority(url):
    """``urlparse(url).netloc``; '' when absent."""
    return _f(S.url_authority, url)


def source_name(feed_url):
    """Host lowered, one leading ``www.`` off, first label title-cased."""
    return _f(S.source_name, feed_url)


def md5_of(*cols):
    return col(S.md5_of(*[sql_of(c) for c in cols]))


def dedup_key(title, url):
    """``md5(title + url)``, no separator."""
    return _f(S.dedup_key, title, url)


def article_id(title, link, name):
    """``{source_name or 'unknown'}_{md5(title+link)}``."""
    return _f(S.article_id, title, link, name)


def processor_source(feed):
    return _f(S.processor_source, feed)


def processor_id(title, url, feed):
    return _f(S.processor_id, title, url, feed)


def api_source(feed):
    return _f(S.api_source, feed)


def api_id(title, url, feed):
    return _f(S.api_id, title, url, feed)


def iso_text(ts):
    return _f(S.iso_text, ts)


def parse_published(text, run_ts: str = C.DEFAULT_RUN_TS):
    """RFC-822 (weekday optional), else ISO 8601 (``Z``/offset), else the run
    timestamp; as ISO text (UTC, no zone)."""
    return _f(S.parse_published, text, run_ts=run_ts)


def rfc822(ts):
    return _f(S.rfc822, ts)


def display_date(c):
    """``Jan 5, 2024``; empty -> ``Unknown date``; unparsable -> ``Invalid Date``."""
    return _f(S.display_date, c)


def display_source(c):
    """Browser source label (see the SQL builder)."""
    return _f(S.display_source, c)


def embedding_text(title, summary, content, limit: int = C.EMBED_TEXT_CHARS):
    return _f(S.embedding_text, title, summary, content, limit=limit)


def lead_words(c, n: int = C.SUMMARY_WORDS):
    return _f(S.lead_words, c, n=n)


def tokens(c):
    """Lower-case ASCII letter runs."""
    return _f(S.tokens, c)


def hash_bucket(word, dim: int = C.EMBED_DIM):
    """First 32 bits of md5(token), modulo ``dim``."""
    return _f(S.hash_bucket, word, dim=dim)


def parse_batch_response(text, n):
    """Split on the separator, strip, drop blanks, pad with '', cut to ``n``."""
    return col(S.parse_batch_response(sql_of(text), str(n) if isinstance(n, int) else sql_of(n)))


def s(text: str):
    return col(S.lit(text))
