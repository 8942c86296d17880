"""Field extraction from feed entries (columns of the RSS_ENTRY struct).

``nullif(x, '')`` is used exactly where a present-but-empty value counts as
missing (truthiness tests); elsewhere a present empty value wins.
"""

from __future__ import annotations

from . import sql as S
from ._expr import col, sql_of


def content_coalesce(content, description, summary, summary_detail_value):
    """content[0].value (a non-empty list wins even with ''), else
    description, summary, summary_detail.value; else ''."""
    return col(S.content_coalesce(*[sql_of(x) for x in (content, description, summary, summary_detail_value)]))


def entry_categories(tags, category):
    """tags[].term (blank terms kept); else the category list; else []."""
    return col(S.entry_categories(sql_of(tags), sql_of(category)))


def entry_tags(tags, categories):
    """Per tag: non-empty term, else non-empty label; none left -> categories."""
    return col(S.entry_tags(sql_of(tags), sql_of(categories)))


def entry_author(author, author_detail_name):
    """author, else author_detail.name, else ''."""
    return col(S.entry_author(sql_of(author), sql_of(author_detail_name)))
