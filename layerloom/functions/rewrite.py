"""Text rewriting as column expressions: one pass over the text, no Python per row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerloom.fixed_values import SECTIONS
from layerloom.functions.text import any_of

# Target, optional anchor, optional display.
WIKILINK = r"\[\[([^\]|#\[]+)(?:#([^\]|]*))?(?:\|([^\]]*))?\]\]"
# Display, address.
MARKDOWN_LINK = r"\[([^\[\]]*)\]\(([^()\s]*)\)"
# Address of an HTML anchor, display.
HTML_LINK = r"""<a\s[^>]*?href="([^"]*)"[^>]*>([^<]*)</a>"""


def pieces(text: Column, pattern: str | Column) -> Column:
    """Cut a text into matches of ``pattern`` and the runs between them.

    Joining the array gives the text back. A run is a single piece, so the array stays short.
    """
    body = F.lit(pattern) if isinstance(pattern, str) else pattern
    whole = F.concat(F.lit("(?s)(?:"), body, F.lit(")|.+?(?="), body, F.lit(r"|\z)"))
    return F.regexp_extract_all(text, whole, F.lit(0))


def rewrite_pieces(
    text: Column, pattern: str, rewrite: Callable[[Column], Column]
) -> Column:
    """Replace every match of ``pattern`` by ``rewrite(match)`` in one pass."""
    is_match = rf"(?s)^(?:{pattern})$"
    return F.array_join(
        F.transform(
            pieces(text, pattern), lambda p: F.when(p.rlike(is_match), rewrite(p)).otherwise(p)
        ),
        "",
    )


def section_links(text: Column, sections: Sequence[str] = SECTIONS, prefix: str = "../../../") -> Column:
    """Give bare ``](<section>/index.md)`` links their depth prefix; others stay as they are."""
    return F.regexp_replace(text, rf"\]\(((?:{any_of(sections)})/index\.md)\)", rf"]({prefix}$1)")


def bare_section_links(text: Column, sections: Sequence[str] = SECTIONS) -> Column:
    """How many links still lack the prefix."""
    return F.regexp_count(text, F.lit(rf"\]\((?:{any_of(sections)})/index\.md\)"))


def unwiki_fields(front_matter: Column, keys: Sequence[str] = ("subject", "object")) -> Column:
    """On the lines of the given keys, show wikilinks as code spans joined by a space."""
    head = rf"^({any_of(keys)}):[ \t]*"

    def line(value: Column) -> Column:
        links = F.regexp_extract_all(value, F.lit(WIKILINK), F.lit(1))
        shown = F.array_join(F.transform(links, lambda t: F.concat(F.lit("`"), t, F.lit("`"))), " ")
        changed = F.concat(F.regexp_extract(value, head, 1), F.lit(": "), shown)
        return F.when(value.rlike(head) & (F.size(links) > 0), changed).otherwise(value)

    return F.array_join(F.transform(F.split(front_matter, "\n"), line), "\n")
