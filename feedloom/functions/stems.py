"""English word stems (the Porter2 rules) as column expressions.

Every step is a projection over a word column, so a table of distinct words is
stemmed without Python and without a shuffle.  Words of two letters and words
that hold a digit or an underscore are their own stems.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOWEL, OTHER = "[aeiouy]", "[^aeiouy]"
# Words with stems of their own, and those left after the plural.
IRREGULAR = {
    "skis": "ski",
    "skies": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "idly": "idl",
    "gently": "gentl",
    "ugly": "ugli",
    "early": "earli",
    "only": "onli",
    "singly": "singl",
    "sky": "sky",
    "news": "news",
    "howe": "howe",
    "atlas": "atlas",
    "cosmos": "cosmos",
    "bias": "bias",
    "andes": "andes",
}
AFTER_PLURAL = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
# Beginnings after which the first region starts.
BEGINNINGS = "gener|commun|arsen"
# Endings of the second, third and fourth step, and what replaces them.
STEP_2 = {
    "tional": "tion",
    "enci": "ence",
    "anci": "ance",
    "abli": "able",
    "entli": "ent",
    "izer": "ize",
    "ization": "ize",
    "ational": "ate",
    "ation": "ate",
    "ator": "ate",
    "alism": "al",
    "aliti": "al",
    "alli": "al",
    "fulness": "ful",
    "ousli": "ous",
    "ousness": "ous",
    "iveness": "ive",
    "iviti": "ive",
    "biliti": "ble",
    "bli": "ble",
    "ogi": "og",
    "fulli": "ful",
    "lessli": "less",
    "li": "",
}
STEP_3 = {
    "tional": "tion",
    "ational": "ate",
    "alize": "al",
    "icate": "ic",
    "iciti": "ic",
    "ical": "ic",
    "ful": "",
    "ness": "",
    "ative": "",
}
STEP_4 = (
    "al",
    "ance",
    "ence",
    "er",
    "ic",
    "able",
    "ible",
    "ant",
    "ement",
    "ment",
    "ent",
    "ism",
    "ate",
    "iti",
    "ous",
    "ive",
    "ize",
    "ion",
)
SHORT_SYLLABLE = f"(^{VOWEL}{OTHER}$)|({OTHER}{VOWEL}[^aeiouywxY]$)"


def _ending(word: Column, endings: list[str]) -> Column:
    """The longest of ``endings`` that ``word`` has, or ''."""
    return F.regexp_extract(word, f"({'|'.join(endings)})$", 1)


def _without(word: Column, ending: Column) -> Column:
    return F.left(word, F.length(word) - F.length(ending))


def stem_words(words: DataFrame, word: str = "term", stem: str = "stem") -> DataFrame:
    """Adds ``stem`` to a table with lower-case words in ``word``; null is null."""
    w, cut, ending = F.col("_w"), F.col("_cut"), F.col("_ending")
    columns = words.columns

    def step(rows: DataFrame, endings: list[str], new: Column) -> DataFrame:
        rows = rows.withColumn("_ending", _ending(w, endings)).withColumn("_cut", _without(w, ending))
        return rows.withColumn("_w", F.when(ending == "", w).otherwise(new))

    def inside(region: str) -> Column:
        return F.length(cut) >= F.col(region)

    def replacement(table: dict[str, str]) -> Column:
        return F.create_map(*[F.lit(x) for item in table.items() for x in item])[ending]

    marked = F.regexp_replace(F.regexp_replace(F.col(word), "^y", "Y"), f"({VOWEL})y", "$1Y")
    rows = words.withColumn("_w", marked)
    first = F.length(F.regexp_extract(w, f"^({BEGINNINGS}|.*?{VOWEL}{OTHER})", 1))
    rows = rows.withColumn("_r1", F.when(first > 0, first).otherwise(F.length(w)))
    rest = F.substring(w, F.col("_r1") + 1, F.length(w))
    second = F.length(F.regexp_extract(rest, f"^(.*?{VOWEL}{OTHER})", 1))
    rows = rows.withColumn("_r2", F.when(second > 0, F.col("_r1") + second).otherwise(F.length(w)))

    plural = (
        F.when(ending == "sses", F.concat(cut, F.lit("ss")))
        .when(ending.isin("ied", "ies"), F.concat(cut, F.when(F.length(cut) > 1, "i").otherwise("ie")))
        .when((ending == "s") & w.rlike(f"{VOWEL}.+s$"), cut)
        .otherwise(w)
    )
    rows = step(rows, ["sses", "ied", "ies", "us", "ss", "s"], plural)
    rows = rows.withColumn("_done", w.isin(*AFTER_PLURAL)).withColumn("_plural", w)

    verb = (
        F.when(ending.isin("eed", "eedly"), F.when(inside("_r1"), F.concat(cut, F.lit("ee"))).otherwise(w))
        .when(~cut.rlike(VOWEL), w)
        .when(cut.rlike("(at|bl|iz)$"), F.concat(cut, F.lit("e")))
        .when(cut.rlike("(bb|dd|ff|gg|mm|nn|pp|rr|tt)$"), F.left(cut, F.length(cut) - 1))
        .when((F.col("_r1") >= F.length(cut)) & cut.rlike(SHORT_SYLLABLE), F.concat(cut, F.lit("e")))
        .otherwise(cut)
    )
    rows = step(rows, ["eed", "eedly", "ed", "edly", "ing", "ingly"], verb)
    rows = rows.withColumn("_w", F.regexp_replace(w, f"^(.+{OTHER})[yY]$", "$1i"))

    allowed = inside("_r1") & F.when(ending == "li", cut.rlike("[cdeghkmnrt]$")).when(
        ending == "ogi", F.endswith(cut, F.lit("l"))
    ).otherwise(True)
    rows = step(rows, list(STEP_2), F.when(allowed, F.concat(cut, replacement(STEP_2))).otherwise(w))
    allowed = inside("_r1") & ((ending != "ative") | inside("_r2"))
    rows = step(rows, list(STEP_3), F.when(allowed, F.concat(cut, replacement(STEP_3))).otherwise(w))
    allowed = inside("_r2") & ((ending != "ion") | cut.rlike("[st]$"))
    rows = step(rows, list(STEP_4), F.when(allowed, cut).otherwise(w))
    last = F.when(
        ending == "e", inside("_r2") | (inside("_r1") & ~cut.rlike(SHORT_SYLLABLE))
    ).otherwise(inside("_r2") & F.endswith(cut, F.lit("l")))
    rows = step(rows, ["e", "l"], F.when(last, cut).otherwise(w))

    known = F.create_map(*[F.lit(x) for item in IRREGULAR.items() for x in item])
    out = F.replace(F.when(F.col("_done"), F.col("_plural")).otherwise(w), F.lit("Y"), F.lit("y"))
    plain = (F.length(word) <= 2) | F.col(word).rlike(r"[\p{N}_]")
    out = F.when(plain, F.col(word)).otherwise(F.coalesce(F.try_element_at(known, F.col(word)), out))
    return rows.select(*[c for c in columns if c != stem], out.alias(stem))
