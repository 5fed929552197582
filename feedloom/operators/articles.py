"""Long-form articles: block arrays to Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.variants import is_text, take, text_of, text_or_empty, truthy

# Markdown prefix of each prefixed block type.
PREFIXES = {
    "header-one": "# ",
    "header-two": "## ",
    "header-three": "### ",
    "blockquote": "> ",
    "unordered-list-item": "- ",
}
NUMBERED = "ordered-list-item"
FENCED = "code-block"
SKIPPED = "atomic"

ARTICLE_PATH = "$.article.article_results.result"


def _block_markdown(kind: Column, text: Column, number: Column) -> Column:
    out = F.when(kind == NUMBERED, F.concat(number.cast("string"), F.lit(". "), text)).when(
        kind == FENCED, F.concat(F.lit("```\n"), text, F.lit("\n```"))
    )
    for name, prefix in PREFIXES.items():
        out = out.when(kind == name, F.concat(F.lit(prefix), text))
    return out.otherwise(text)


def blocks_to_markdown(blocks: Column) -> Column:
    """Markdown of an ``array<struct<type:string,text:string>>``.

    Skipped and empty blocks leave a numbered list running; any other block
    restarts it.  Works inside the row in time proportional to its blocks: the
    numbers come from the lengths of the runs of numbered blocks.
    """
    shown = F.filter(
        blocks,
        lambda b: ~F.coalesce(b["type"] == SKIPPED, F.lit(False))
        & (F.coalesce(b["text"], F.lit("")) != ""),
    )
    marks = F.transform(shown, lambda b: F.when(b["type"] == NUMBERED, F.lit("n")).otherwise(F.lit("|")))
    runs = F.split(F.array_join(marks, ""), r"\|", -1)
    # A run counts up; the block that ends it has no number.
    counted = F.transform(
        runs,
        lambda r: F.concat(
            F.when(r == "", F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.length(r))),
            F.array(F.lit(0)),
        ),
    )
    numbers = F.slice(F.flatten(counted), F.lit(1), F.size(shown))
    parts = F.zip_with(shown, numbers, lambda b, n: _block_markdown(b["type"], b["text"], n))
    return F.array_join(parts, "\n\n")


def articles_to_markdown(posts: DataFrame, column: str = "v") -> DataFrame:
    """Add ``title`` and ``text`` read from a post node; both empty if no article."""
    node = take(F.col(column), "struct<title:variant,content_state:struct<blocks:variant>>", ARTICLE_PATH)
    read = posts.withColumn("_article", node).withColumn(
        "_blocks", take(F.col("_article.content_state.blocks"), "array<struct<type:variant,text:variant>>")
    )
    # One unreadable block spoils the text of the whole article.
    readable = ~F.exists(
        "_blocks",
        lambda b: b.isNull() | (truthy(b["text"]) & ~is_text(b["text"]) & (text_of(b["type"]) != SKIPPED)),
    )
    blocks = F.transform(
        "_blocks",
        lambda b: F.struct(
            F.when(is_text(b["type"]), text_of(b["type"])).otherwise(F.lit("unstyled")).alias("type"),
            text_or_empty(b["text"]).alias("text"),
        ),
    )
    title = F.coalesce(text_or_empty(F.col("_article.title")), F.lit(""))
    text = F.when(readable, blocks_to_markdown(blocks))
    return read.withColumns({"title": title, "text": F.coalesce(text, F.lit(""))}).drop(
        "_article", "_blocks"
    )
