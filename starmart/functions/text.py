"""Splitters for comma-separated source texts.

Each schema has its own separator rule, and they differ on ``"a,b"``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---- fixed values: separators, as regular expressions ----
COMMA_ANY_SPACE = r",\s*"
COMMA_SPACE = ", "
COMMA = ","

# ---- fixed values: texts that do not count as a category ----
BLANK = [""]
BLANK_OR_NULL_TEXT = ["", "null"]


def split_text(text: str | Column, separator: str) -> Column:
    return F.split(text, separator)


def valid_token(token: str | Column, drop: list[str]) -> Column:
    """Neither null nor one of the texts to drop."""
    token = F.col(token) if isinstance(token, str) else token
    return token.isNotNull() & ~token.isin(*drop)


def subcategory(categories: str) -> Column:
    """The second listed category, or null. ``get`` is the access that never throws."""
    second = F.get(split_text(categories, COMMA_ANY_SPACE), 1)
    return F.when(valid_token(second, BLANK_OR_NULL_TEXT), second)
