"""Canonical text.

Two of the eight steps (compatibility composition and entity decoding) have no
Spark built-in; they run in one Arrow function that only receives the texts
they can change, and that folds single characters too, as plain text has none
to fold.  All other steps are JVM expressions.
"""

from __future__ import annotations

import html
import json
import sys
import unicodedata
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters that are folded to others.
FOLDED = {
    "\u2018": "'",
    "\u2019": "'",
    "\u201c": '"',
    "\u201d": '"',
    "\u2014": "--",
    "\u2013": "-",
    "\u2026": "...",
    "\u00a0": " ",
    "\u00ab": '"',
    "\u00bb": '"',
}
# Invisible characters that are removed.
ZERO_WIDTH = "\u00ad\u180e\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\u2064\ufeff"
# The characters Unicode text treats as blank.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: the host of short links, one of which may end a text.
LINK_HOST = "://t.co/"
LINK_REST = rf"\A[\p{{L}}\p{{N}}_]++[{BLANKS}]*+\z"


def _decode(text: str | None) -> str | None:
    """Composition, entities and folded characters of one text.

    The two commonest characters that composition would replace are replaced
    first, with the same result, so that most texts need no composition.
    """
    if text is None:
        return None
    text = text.replace("\u2026", "...").replace("\u00a0", " ")
    if not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    if "&" in text:
        text = html.unescape(text)
    for char, spelled in FOLDED.items():
        text = text.replace(char, spelled)
    for char in ZERO_WIDTH:
        text = text.replace(char, "")
    return text


# Texts of a batch that are Python text at once; all of them would take several
# times the batch.
PIECE = 16


def _each(texts: pa.Array, change: Callable[[str | None], str | None]) -> pa.Array:
    if texts.null_count == len(texts):  # most batches: no text that composition could change
        return pa.nulls(len(texts), pa.string())
    pieces = (texts.slice(i, PIECE).to_pylist() for i in range(0, max(len(texts), 1), PIECE))
    return pa.concat_arrays([pa.array([change(t) for t in piece], pa.string()) for piece in pieces])


def _decode_column(texts: pa.Array) -> pa.Array:
    return _each(texts, _decode)


def _decode_lists(lists: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(
        pc.subtract(lists.offsets, lists.offsets[0]), _decode_column(lists.flatten()), mask=lists.is_null()
    )


def _decode_json(texts: pa.Array) -> pa.Array:
    """Lists as JSON texts: Spark's Arrow writer takes the square of a batch's rows for lists."""

    def decoded(text: str | None) -> str | None:
        if text is None:
            return None
        lists = pa.array([json.loads(text)], pa.list_(pa.string()))
        return json.dumps(_decode_lists(lists)[0].as_py(), ensure_ascii=False)

    return _each(texts, decoded)


# Executors get these small functions by value; they need no package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

decode = F.arrow_udf(_decode_column, T.StringType())
# Declared nondeterministic only so that Catalyst keeps the parse steps apart:
# a filter on parsed columns would otherwise be pushed below them, repeating
# every step inside the filter.
decode_fenced = F.arrow_udf(_decode_column, T.StringType()).asNondeterministic()
decode_lists = F.arrow_udf(_decode_json, T.StringType()).asNondeterministic()


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def _needs_decoding(text: Column) -> Column:
    """A text of plain ASCII without ``&`` is a fixed point of these steps."""
    return ~_is_ascii(text) | F.contains(text, F.lit("&"))


def _only_if(condition: Column, changed: Column, text: Column) -> Column:
    return F.when(condition, changed).otherwise(text)


def _fold_link(text: Column) -> Column:
    """Without the short link at the very end; only what follows the last one is searched."""
    rest = F.substring_index(text, LINK_HOST, -1)
    head = F.left(text, F.length(text) - F.length(rest) - len(LINK_HOST))
    secure = F.endswith(head, F.lit("https"))
    cut = F.rtrim(F.left(head, F.length(head) - F.when(secure, 5).otherwise(4)), F.lit(BLANKS))
    link = F.contains(text, F.lit(LINK_HOST)) & rest.rlike(LINK_REST) & (secure | F.endswith(head, F.lit("http")))
    return _only_if(link, cut, text)


def _fold_blanks(text: Column) -> Column:
    spaced = _only_if(F.contains(text, F.lit("\t")), F.replace(text, F.lit("\t"), F.lit(" ")), text)
    return _only_if(
        F.contains(text, F.lit("  ")) | F.contains(text, F.lit("\t")),
        F.regexp_replace(spaced, "  +", " "),
        text,
    )


def _fold_lines(text: Column) -> Column:
    return _only_if(
        F.contains(text, F.lit("\n\n\n")), F.regexp_replace(text, r"\n{3,}", "\n\n"), text
    )


def _fold(texts: Column) -> Column:
    """The remaining steps over an array; each ``transform`` names one step.

    Every step is guarded by a cheap test that holds whenever it would act, so
    long texts are not scanned by patterns that cannot match.
    """
    for step in (_fold_link, _fold_blanks, _fold_lines, lambda t: F.trim(t, F.lit(BLANKS))):
        texts = F.transform(texts, step)
    return texts


def normalize_text(text: Column, fenced: bool = False) -> Column:
    """Canonical form of a text column; null and empty give ``''``."""
    raw = F.coalesce(text, F.lit(""))
    step = decode_fenced if fenced else decode
    decoded = step(F.when(_needs_decoding(raw), raw))
    return F.get(_fold(F.array(F.coalesce(decoded, raw))), F.lit(0))


def normalize_texts(texts: Column) -> Column:
    """``normalize_text`` over an array column; a null array stays null."""
    needed = F.exists(texts, _needs_decoding)
    decoded = F.from_json(decode_lists(F.when(needed, F.to_json(texts))), "array<string>")
    decoded = F.coalesce(decoded, texts)
    return _fold(F.transform(decoded, lambda t: F.coalesce(t, F.lit(""))))
