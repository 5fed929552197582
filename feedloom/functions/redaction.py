"""Masking secrets in text, map and array columns; JVM expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keys whose map values are masked.
SENSITIVE_KEYS = (
    "auth_token",
    "ct0",
    "cookie",
    "authorization",
    "x-csrf-token",
    "x-guest-token",
    "password",
    "token",
    "bearer",
    "secret",
    "api_key",
    "apikey",
)
# Keys looked for in text.
TEXT_KEYS = (
    r"auth_token|ct0|cookie|authorization|x-csrf-token|x-guest-token"
    r"|bearer|password|token|secret|api_key"
)
# Fixed value: a text that looks like a token as a whole.
TOKEN = r"\A[A-Za-z0-9+/=_\-]{40,}\n?\z"
# The same as a word between blanks.
TOKEN_WORD = r"(?U)(?<!\S)[A-Za-z0-9+/=_\-]{40,}+(?!\S)"
KEPT_CHARS = 4

# (?iU): letters in any case, and Unicode blanks, as in the text at large.
PLAIN_PATTERN = rf"(?iU)({TEXT_KEYS})\s*[=:]\s*[\"']?(\S+)"
# Strict mode reads on after an authentication scheme word.
STRICT_PATTERN = rf"(?iU)({TEXT_KEYS})\s*[=:]\s*[\"']?(?:(?:bearer|basic|digest)\s+)?(\S+)"
PATTERNS = {"plain": PLAIN_PATTERN, "strict": STRICT_PATTERN}


def mask_secret(value: Column, keep: int = KEPT_CHARS) -> Column:
    """Stars for all but ``keep`` characters at each end; short values entirely."""
    size = F.length(value)
    return F.when(size <= 2 * keep, F.repeat(F.lit("*"), size)).otherwise(
        F.concat(F.left(value, F.lit(keep)), F.repeat(F.lit("*"), size - 2 * keep), F.right(value, F.lit(keep)))
    )


# Without one of these no sensitive key is in a text.
KEY_PARTS = ("token", "ct0", "cookie", "authorization", "bearer", "password", "secret", "api_key")
# Letters that a search in any case takes for s, i, i and k.
ALIKE_FROM, ALIKE_TO = "\u017f\u0131\u0130\u212a", "siik"


def may_hold_key(text: Column) -> Column:
    """A cheap test that is true wherever a sensitive key occurs; most texts stop here."""
    ascii_only = F.octet_length(text) == F.length(text)
    lower = F.lower(F.when(ascii_only, text).otherwise(F.translate(text, ALIKE_FROM, ALIKE_TO)))

    def any_part(t: Column) -> Column:
        found = F.contains(t, F.lit(KEY_PARTS[0]))
        for part in KEY_PARTS[1:]:
            found = found | F.contains(t, F.lit(part))
        return found

    return F.get(F.transform(F.array(lower), any_part), F.lit(0))


def redact_text(text: Column, mode: str = "strict") -> Column:
    """``key: "value`` -> ``key=masked`` wherever a sensitive key is set.

    One search per text: it sets a mark around keys and values, at which the text
    is then cut and put together again.  The mark holds the text's own digest, so
    no text can have it.
    """
    pattern = PATTERNS[mode]

    def rebuilt(mark: Column) -> Column:
        marked = F.regexp_replace(
            text, F.lit(pattern), F.concat(mark, F.lit("$1"), mark, F.lit("$2"), mark)
        )
        # Gap, key, value, gap, key, value, ..., gap.
        parts = F.transform(
            F.split(marked, mark, -1),
            lambda p, i: F.when(i % 3 == 1, F.concat(p, F.lit("="))).when(i % 3 == 2, mask_secret(p)).otherwise(p),
        )
        return F.array_join(parts, "")

    mark = F.concat(F.lit("\u0001"), F.sha2(text, 256))
    return F.when(may_hold_key(text), F.get(F.transform(F.array(mark), rebuilt), F.lit(0))).otherwise(text)


def sensitive_keys(text: Column, mode: str = "strict") -> Column:
    """The sensitive keys that are given a value, as written."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS[mode]), F.lit(1))
    return F.when(may_hold_key(text), found).otherwise(F.array().cast("array<string>"))


def secret_words(text: Column) -> Column:
    """The blank-separated words that look like a secret."""
    return F.regexp_extract_all(text, F.lit(TOKEN_WORD), F.lit(0))


def looks_like_secret(value: Column) -> Column:
    return value.rlike(TOKEN)


def redact_map(values: Column) -> Column:
    return F.transform_values(
        values, lambda k, v: F.when(F.lower(k).isin(*SENSITIVE_KEYS), mask_secret(v)).otherwise(v)
    )


def redact_array(values: Column) -> Column:
    return F.transform(values, lambda v: F.when(looks_like_secret(v), mask_secret(v)).otherwise(v))
