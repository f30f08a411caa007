"""Text composed from record columns: embedding, topic and search texts, and prompt entries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphatlas.functions.display import clean_author
from glyphatlas.functions.strings import head, strip, text_or_empty
from glyphatlas.vocab import (
    EMBED_BUDGETS,
    EMBED_TEXT_DROP,
    PROMPT_BUDGETS,
    SEARCH_COMMENT_CHARS,
    TAXONOMY_KEYWORDS,
    TAXONOMY_TEXT_CHARS,
    TOPIC_COMMENT_CHARS,
)


def _text(name: str) -> Column:
    return text_or_empty(F.col(name))


def _keywords() -> Column:
    return F.coalesce(F.col("keywords"), F.array().cast("array<string>"))


def embed_text(budgets: dict[str, int] = EMBED_BUDGETS, drop: tuple[str, ...] = EMBED_TEXT_DROP) -> Column:
    """Text to embed: content keywords are left out, order and repeats of the others stay."""
    kept = F.filter(_keywords(), lambda k: ~k.isin(*drop))
    parts = {
        "Name: ": head(strip(_text("name")), budgets["name"]),
        "\nKeywords: ": F.array_join(kept, ", "),
        "\nFirst values: ": _text("values_preview_str"),
        "\nDescription:\n": head(_text("comments"), budgets["comments"]),
        "\nFormula: ": head(_text("formulas"), budgets["formulas"]),
        "\nExamples:\n": head(_text("examples"), budgets["examples"]),
    }
    return F.concat(*[c for label, part in parts.items() for c in (F.lit(label), part)])


def topic_doc(limit: int = TOPIC_COMMENT_CHARS) -> Column:
    return F.concat(
        strip(_text("name")),
        F.lit(" — first values "),
        _text("values_preview_str"),
        F.lit("\n"),
        head(_text("comments"), limit),
    )


def taxonomy_doc(limit: int = TAXONOMY_TEXT_CHARS, n_keywords: int = TAXONOMY_KEYWORDS) -> Column:
    return F.concat(
        strip(_text("name")),
        F.lit(" ["),
        F.array_join(F.slice(_keywords(), 1, n_keywords), ","),
        F.lit("] "),
        _text("values_preview_str"),
        F.lit("\n"),
        head(_text("comments"), limit),
        F.lit("\n"),
        head(_text("formulas"), limit),
    )


def prompt_entry(place: Column, title: str = "Sequence", budgets: dict[str, int] = PROMPT_BUDGETS) -> Column:
    """One numbered block of a classification prompt; `place` is the 0-based place in the batch."""
    unknown = F.lit("(unknown)")
    parts = {
        f"\n--- {title} ": place.cast("string"),
        " ---\nID: ": F.coalesce("id", F.lit("?")),
        "\nName: ": strip(_text("name")),
        "\nOffset: ": _text("offset"),
        "\nValues: ": _text("values_preview_str"),
        "\nKeywords: ": F.array_join(_keywords(), ", "),
        "\nAuthor: ": F.coalesce(head(F.col("author"), budgets["author"]), unknown),
        "\nLastEdited: ": F.coalesce(F.year("last_edited").cast("string"), unknown),
        "\nComments: ": head(_text("comments"), budgets["comments"]),
        "\nFormula: ": head(_text("formulas"), budgets["formulas"]),
    }
    return F.concat(*[c for label, part in parts.items() for c in (F.lit(label), part)])


def search_text(limit: int | None = SEARCH_COMMENT_CHARS) -> Column:
    """Text to search in; `limit` None takes the whole comments."""
    flat = F.replace(_text("comments"), F.lit("\n"), F.lit(" "))
    flat = flat if limit is None else head(flat, limit)
    return F.concat_ws(" ", "id", "name", clean_author(F.col("author")), flat)
