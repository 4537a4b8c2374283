"""Text functions on columns: repair, comparison keys, slugs, names. Null in, null out, unless said otherwise."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Latin letters and the Cyrillic letters that they are mistaken for.
LATIN_LOOKALIKES = "iIaAeEoOpPcCxXyHBKMT"
CYRILLIC_LETTERS = "іІаАеЕоОрРсСхХуНВКМТ"
# Letters that count as Cyrillic next to a look-alike.
CYRILLIC = "а-яА-ЯіІїЇєЄґҐ"
# Quotation marks that may wrap a title, marks that stand for an apostrophe, marks that comparison drops.
QUOTES = "\"'«»“”„‘’`"
APOSTROPHES = "'`’ʼ"
DROPPED_QUOTES = '«»"“”'
#: A private-use character that stands for an apostrophe between letters while the others are dropped.
BETWEEN = "\ue000"
#: A private-use character before a look-alike that is to be replaced.
MARK = "\ue001"
# Suffix codes of a title in round brackets.
SUFFIX_CODES = "бн|зс|[a-zA-Zа-яА-ЯіІїЇєЄ]"
# Transliteration of a slug, multi-letter results first.
TRANSLITERATION = {"щ": "shch", "є": "ie", "ж": "zh", "ї": "i", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "ю": "iu", "я": "ia", "ь": "", "'": ""}
TRANSLITERATION_FROM, TRANSLITERATION_TO = "абвгґдезиійклмнопрстуф", "abvhgdezyiiklmnoprstuf"
#: The ASCII characters that are left of a character's compatibility decomposition, for each character beyond ASCII that has some: a rule.
ASCII_OF = {c: left for c in map(chr, (*range(0x80, 0xD800), *range(0xE000, 0x110000))) if (left := "".join(b for b in unicodedata.normalize("NFKD", c) if b < "\x80"))}
#: Those with one, and those with several, as "½" and ligatures.
ONE_OF = {c: left for c, left in ASCII_OF.items() if len(left) == 1}
SEVERAL_OF = {c: left for c, left in ASCII_OF.items() if len(left) > 1}


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value evaluated once, however often it is used: without it, nested repairs would repeat their inputs."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fix_homoglyphs(s: Column) -> Column:
    """Latin look-alikes within or at the edge of a Cyrillic word become Cyrillic (FN1).

    One neighbour must be Cyrillic, the other Cyrillic or no letter. One pass marks them: a marked letter never has a Latin
    neighbour, so none depends on another. Texts without Cyrillic letters are left alone.
    """
    marked = F.regexp_replace(s, f"((?<=[{CYRILLIC}])[{LATIN_LOOKALIKES}](?![a-zA-Z])|(?<![a-zA-Z])[{LATIN_LOOKALIKES}](?=[{CYRILLIC}]))", f"{MARK}$1")
    for latin, cyrillic in zip(LATIN_LOOKALIKES, CYRILLIC_LETTERS, strict=True):
        marked = F.replace(marked, F.lit(MARK + latin), F.lit(cyrillic))
    return F.when(s.rlike(f"[{CYRILLIC}]"), marked).otherwise(s)


def strip_quotes(s: Column) -> Column:
    """A pair of quotation marks around the whole goes; one alone stays (FN2)."""
    wrapped = (F.length(s) >= 2) & F.lit(QUOTES).contains(F.left(s, F.lit(1))) & F.lit(QUOTES).contains(F.right(s, F.lit(1)))
    return F.when(wrapped, trim(F.substring(s, F.lit(2), F.length(s) - 2))).otherwise(s)


def trim(s: Column) -> Column:
    """All white space at the ends, not only blanks."""
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


#: White space beside the blank, as a character class holds it: all that Unicode counts as such.
OTHER_SPACE = r"\t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def collapse(s: Column) -> Column:
    """Runs of white space become one blank, none at the ends; single blanks, which are most, are left where they are."""
    return F.trim(F.regexp_replace(s, f" [ {OTHER_SPACE}]+|[{OTHER_SPACE}][ {OTHER_SPACE}]*", " "))


def fix_stray_apostrophe(s: Column) -> Column:
    """A backtick between two letters becomes an apostrophe (FN3)."""
    return F.regexp_replace(s, r"(?<=\p{L})`(?=\p{L})", "’")


# Stems of the adjectives and the nouns of a packaging phrase, in the case that follows its preposition.
PACKAGING_STEMS, PACKAGING_NOUNS, PACKAGING_IN = ("сувенірн", "подарунков"), ("упаковці", "пакованні"), "у"
PACKAGING = rf"(?iuU)\s+{PACKAGING_IN}\s+({'|'.join(PACKAGING_STEMS)})\w*\s+(?:{'|'.join(PACKAGING_NOUNS)})\s*$"


def split_packaging(s: Column) -> Column:
    """struct(base, tail, key): a packaging phrase at the end split off; tail and key are null without one (FN4)."""
    tail = F.regexp_extract(s, PACKAGING, 0)
    has = tail != ""
    return F.struct(
        F.when(has, F.regexp_replace(F.regexp_replace(s, PACKAGING, ""), r"(?U)\s+$", "")).otherwise(s).alias("base"),
        F.when(has, trim(tail)).alias("tail"),
        F.when(has, F.lower(F.regexp_extract(s, PACKAGING, 1))).alias("key"),
    )


SUFFIX = rf"(?U)\s*\(({SUFFIX_CODES})\)\s*$"


def peel_suffix(s: Column) -> Column:
    """struct(rest, code): a suffix code at the end taken off; the code is null without one."""
    return let(F.regexp_extract(s, SUFFIX, 1), lambda code: F.struct(F.when(code != "", F.regexp_replace(s, SUFFIX, "")).otherwise(s).alias("rest"), F.nullif(code, F.lit("")).alias("code")))


def normalize_title(s: Column) -> Column:
    """struct(title, suffix): suffix code and packaging phrase are peeled off in either order, once each; quotes and
    apostrophes are repaired on what is left, and the phrase is put back (FN5)."""

    def split(first: Column) -> Column:
        return let(split_packaging(first["rest"]), lambda phrase: let(peel_suffix(phrase["base"]), lambda second: whole(first["code"], phrase, second)))

    def whole(code: Column, phrase: Column, second: Column) -> Column:
        # A second code is peeled only after a phrase, and only if there was none before it.
        again = code.isNull() & phrase["tail"].isNotNull()
        body = let(F.when(again, second["rest"]).otherwise(phrase["base"]), strip_quotes)
        title = F.concat(fix_stray_apostrophe(body), F.coalesce(F.concat(F.lit(" "), phrase["tail"]), F.lit("")))
        found = F.coalesce(code, F.when(again, second["code"]))
        return F.struct(collapse(title).alias("title"), F.when(found == "c", F.lit("с")).otherwise(found).alias("suffix"))

    return let(let(trim(s), peel_suffix), split)


def fold_apostrophes(s: Column) -> Column:
    """Between letters one canonical apostrophe, elsewhere none (FN6)."""
    marked = F.regexp_replace(s, rf"(?<=\p{{L}})[{APOSTROPHES}](?=\p{{L}})", BETWEEN)
    return F.when(s.rlike(f"[{APOSTROPHES}]"), F.translate(F.regexp_replace(marked, f"[{APOSTROPHES}]", ""), BETWEEN, "’")).otherwise(s)


def match_key(s: Column) -> Column:
    """What two titles are compared by; not for display (FN7)."""
    s = fold_apostrophes(fix_homoglyphs(s))
    return F.lower(collapse(F.translate(s, "ґҐ" + DROPPED_QUOTES, "гГ")))


def slug(s: Column, empty: str = "series") -> Column:
    """Transliterated letters and digits, joined by hyphens (FN8); other characters leave what is ASCII of their compatibility decomposition."""
    s = F.lower(s)
    for letter, latin in TRANSLITERATION.items():
        s = F.replace(s, F.lit(letter), F.lit(latin))
    s = F.translate(s, TRANSLITERATION_FROM, TRANSLITERATION_TO)
    one = F.translate(s, "".join(ONE_OF), "".join(ONE_OF.values()))
    # Each character is looked up in the table of those with several letters; one that isn't there is dropped.
    table = F.from_json(F.lit(json.dumps(SEVERAL_OF)), "map<string,string>")
    whole = F.array_join(F.transform(F.split(one, ""), lambda c: F.when(c <= "\x7f", c).otherwise(F.coalesce(table[c], F.lit("")))), "")
    s = F.when(s.rlike(r"[^\x00-\x7f]"), whole).otherwise(s)
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(s, "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit("")), F.lit(empty))


def vocabulary_key(s: Column) -> Column:
    """What a label is looked up by (FN9)."""
    return F.lower(trim(fix_homoglyphs(s)))


def preferred(first: Column, second: Column) -> Column:
    """The first value that is neither null nor empty (PJ4)."""
    return F.coalesce(F.nullif(first, F.lit("")), F.nullif(second, F.lit("")))


def three_parts(parts: Column) -> Column:
    """struct of three positional descriptions, empty ones null; any other number is an error flag (PJ2)."""
    def part(i: int) -> Column:
        return F.nullif(trim(F.get(parts, F.lit(i))), F.lit(""))

    right = F.size(parts) == 3
    return F.struct(*(F.when(right, part(i)).alias(n) for i, n in enumerate(("general", "obverse", "reverse"))), (~right).alias("wrong_count"))


def names(s: Column) -> Column:
    """A list of names split at commas and semicolons, each with its look-alikes repaired (FN16)."""
    return F.transform(F.filter(F.transform(F.split(F.coalesce(s, F.lit("")), "[,;]"), trim), lambda n: n != ""), fix_homoglyphs)


def paired_names(first: Column, second: Column) -> Column:
    """Names of two languages by position, the shorter list padded with nulls (FN16)."""
    return F.arrays_zip(names(first).alias("uk"), names(second).alias("en"))


def caption_role(s: Column) -> Column:
    """obverse or reverse if a caption says so (FN20)."""
    return F.when(F.lower(s).rlike("аверс|obverse"), "obverse").when(F.lower(s).rlike("реверс|reverse"), "reverse")


def url_extension(url: Column, default: str = ".jpg") -> Column:
    """The extension of a url's path (FN21)."""
    return F.coalesce(F.nullif(F.regexp_extract(F.regexp_extract(url, r"^[^?#]*", 0), r"/[^/]*(\.[^./]+)$", 1), F.lit("")), F.lit(default))


def shortened(s: Column, most: int = 48) -> Column:
    """Texts over `most` characters end in three dots (FN22)."""
    return F.when(F.length(s) > most, F.concat(F.left(s, F.lit(most - 3)), F.lit("..."))).otherwise(s)


def apostrophe_variants(s: Column) -> Column:
    """The distinct spellings of a name with each apostrophe look-alike, the given one first (FN23)."""
    return F.array_distinct(F.array(s, *(F.regexp_replace(s, f"[{APOSTROPHES}]", mark) for mark in APOSTROPHES)))


def id_as_path(source_id: Column) -> Column:
    """prefix:88 -> prefix_88 (PJ17)."""
    return F.replace(source_id, F.lit(":"), F.lit("_"))


def id_number(source_id: Column) -> Column:
    """prefix:88 or prefix_88 -> 88, to sort ids as numbers (PJ17, SO1)."""
    return F.regexp_extract(source_id, r"[:_](\d+)$", 1).try_cast("int")
