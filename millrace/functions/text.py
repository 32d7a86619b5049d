"""Text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(column: Column) -> Column:
    """Words parted by single spaces; two spaces in a row give an empty word."""
    return F.split(column, " ")


def normalize_name(column: Column) -> Column:
    """Trimmed, with each space-parted word capitalized (letters after ``'`` and ``-`` stay small)."""
    return F.initcap(F.trim(column))


def html_text(column: Column) -> Column:
    """Readable text of a page: scripts, styles, comments and tags out, blanks squeezed."""
    bare = F.regexp_replace(column, r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    bare = F.regexp_replace(bare, r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(bare, r"[ \t\r\n]+", " "))
