"""Text normalizers as column expressions.

There are four notions of a missing value in this domain; each has its own helper and none is
shared: ``is_missing`` (engine), ``is_missing_flag`` (flags), ``blank_to_null`` (registries)
and ``spreadsheet_null`` (values that passed through a spreadsheet).
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Words that stand for a missing value.
MISSING = ("", "nan", "none", "null")
MISSING_FLAG = ("", "nan", "none", "null", "<na>")
SPREADSHEET_MISSING = ("", "#N/A", "#NA", "-NaN", "-nan", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
#: Marks of an event document, in folded text.
EVENT_MARKS = ("application response", "acuse", "aceptacion", "reclamo", "evento", "recibo")


#: White space in the Unicode sense, as a pattern's (?U)\\s has it.
_SPACES = "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


#: Those of them that are separators (Zs).
_SEPARATORS = "".join(c for c in _SPACES if unicodedata.category(c) == "Zs")


def strip(x: Column) -> Column:
    """Without white space at either end, in the Unicode sense."""
    return F.btrim(x, F.lit(_SPACES))


def is_missing(x: Column) -> Column:
    """Null, blank, or one of the words nan, none and null in any case."""
    return x.isNull() | F.lower(strip(x)).isin(*MISSING)


def present(x: Column) -> Column:
    """The value, or null if it is missing."""
    return F.when(~F.lower(strip(x)).isin(*MISSING), x)


def is_missing_flag(x: Column) -> Column:
    return x.isNull() | F.lower(strip(x)).isin(*MISSING_FLAG)


def blank_to_null(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def spreadsheet_null(x: Column) -> Column:
    return F.when(~x.isin(*SPREADSHEET_MISSING), x)


def _unless_plain(x: Column, otherwise: Column) -> Column:
    """Most texts are printable ASCII with single spaces between words: these stay as they are, if not missing; others take the longer way."""
    return F.when(x.rlike("[^ -~]|  |^ | $|^$"), otherwise).otherwise(F.when(~F.lower(x).isin(*MISSING), x))


def _collapsed(x: Column) -> Column:
    return _bound(strip(F.regexp_replace(present(x), r"(?U)\s+", " ")), lambda text: F.nullif(text, F.lit("")))


def collapse(x: Column) -> Column:
    """White space collapsed to single spaces; missing or empty becomes null."""
    return _unless_plain(x, _collapsed(x))


def _decomposed() -> tuple[str, str, dict[str, str]]:
    """Letters whose compatibility decomposition without marks is one letter, and those with more.

    The blocks are the Latin ones, ligatures, superscripts and full-width forms.
    """
    one, to, more = [], [], {}
    for block in ((0xA0, 0x24F), (0x1E00, 0x1EFF), (0x2070, 0x209F), (0x2100, 0x214F), (0xFB00, 0xFB06), (0xFF01, 0xFF5E)):
        for code in range(block[0], block[1] + 1):
            plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
            if plain == chr(code):
                continue
            if len(plain) == 1:
                one.append(chr(code))
                to.append(plain)
            else:
                more[chr(code)] = plain
    return "".join(one), "".join(to), more


_ONE, _TO, _MORE = _decomposed()


def _bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x computed once, however often ``f`` names it."""
    return F.transform(F.array(x), f)[0]


def strip_marks(x: Column) -> Column:
    """Collapsed text with accents dropped and compatibility letters decomposed.

    Only texts with characters beyond ASCII take that path; all of it stays in the JVM.
    """
    pairs = F.create_map(*[F.lit(x) for pair in _MORE.items() for x in pair])
    long = lambda plain: F.array_join(F.transform(F.split(plain, ""), lambda c: F.coalesce(F.try_element_at(pairs, c), c)), "")
    full = lambda plain: F.when(plain.rlike("[" + "".join(_MORE) + "]"), long(plain)).otherwise(plain)
    folded = lambda text: F.regexp_replace(_bound(F.translate(text, _ONE, _TO), full), r"\p{Mn}", "")
    return _unless_plain(x, _bound(_collapsed(x), lambda text: F.when(text.rlike(r"[^\x00-\x7F]"), folded(text)).otherwise(text)))


@cache
def _canonical() -> tuple[str, str]:
    """Characters whose canonical decomposition without marks is another character, those that vanish last, and what they become."""
    kept = lambda c: "".join(d for d in unicodedata.normalize("NFD", c) if unicodedata.category(d)[0] != "M")
    found = {c: unicodedata.normalize("NFC", kept(c)) for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c)[0] == "M" or unicodedata.decomposition(c)[:1] not in ("", "<")}
    found = sorted(((c, plain) for c, plain in found.items() if plain != c), key=lambda pair: not pair[1])
    return "".join(c for c, _ in found), "".join(plain for _, plain in found)


def _syllables(x: Column) -> Column:
    """Hangul letters that stand side by side composed to syllables.  U+11A7 is no letter but the place before the first final one; composed with a syllable it vanishes."""
    parts = F.regexp_extract_all(x, F.lit("[\u1100-\u1112][\u1161-\u1175][\u11a7-\u11c2]?|[\uac00-\ud7a3][\u11a7-\u11c2]|(?s:.)"), F.lit(0))

    def composed(part: Column) -> Column:
        code = lambda at: F.ascii(F.substring(part, at, 1))
        final = lambda at: F.greatest(code(at) - 0x11A7, F.lit(0))
        syllable = F.when(code(1) >= 0xAC00, code(1) + final(2)).otherwise(0xAC00 + ((code(1) - 0x1100) * 21 + code(2) - 0x1161) * 28 + final(3))
        closed = (code(1) >= 0xAC00) & ((code(1) - 0xAC00) % 28 != 0)
        return F.when((F.char_length(part) < 2) | closed, part).otherwise(F.decode(F.unhex(F.hex(syllable)), "UTF-16BE"))

    return F.array_join(F.transform(parts, composed), "")


def unaccent(x: Column) -> Column:
    """What SQL's ``strip_accents`` gives: the canonical decomposition without marks, composed again.

    Unlike ``strip_marks`` it keeps white space, missing words and compatibility letters.  As there, ASCII
    stays as it is and any other text ends at a NUL.
    """
    plain = F.translate(F.substring_index(x, "\0", 1), *_canonical())
    whole = _bound(plain, lambda text: F.when(text.rlike("[\u1161-\u1175\u11a7-\u11c2]"), _syllables(text)).otherwise(text))
    return F.when(F.octet_length(x) == F.char_length(x), x).otherwise(whole)


def squeeze(x: Column) -> Column:
    """SQL's ``\\s+`` to one space and ``trim``: white space of ASCII is collapsed, any kind of space is cut off at the ends; missing words stay."""
    return F.btrim(F.regexp_replace(x, r"[\t\n\f\r ]{2,}|[\t\n\f\r]", " "), F.lit(_SEPARATORS))


@cache
def _lower_case() -> tuple[str, str]:
    """Characters with a lower case of one character, and that."""
    found = [(c, c.lower()) for c in map(chr, range(sys.maxunicode + 1)) if len(c.lower()) == 1 and c.lower() != c]
    return "".join(c for c, _ in found), "".join(low for _, low in found)


def lower_each(x: Column) -> Column:
    """SQL's ``lower`` after ``unaccent``: character by character, so a sigma at the end of a word is no special one, and without the JVM's newer letters, of which none is up to U+052F."""
    return F.when(x.rlike("[^\\x00-\u052f]"), F.translate(x, *_lower_case())).otherwise(F.lower(F.replace(x, F.lit("\u03a3"), F.lit("\u03c3"))))


def basic_text(x: Column) -> Column:
    """Marks dropped, white space collapsed, case kept."""
    return _bound(strip_marks(x), collapse)


def model_text(x: Column) -> Column:
    return _bound(F.lower(strip_marks(x)), collapse)


def alnum_key(x: Column) -> Column:
    """Lower-case letters and digits only; null if nothing is left."""
    return plain_key(strip_marks(x))


def plain_key(plain: Column) -> Column:
    """``alnum_key`` of what ``strip_marks`` has given."""
    return _bound(F.regexp_replace(F.lower(plain), "[^a-z0-9]", ""), lambda key: F.nullif(key, F.lit("")))


def tax_id(x: Column) -> Column:
    """Digits of a tax id given as text; a trailing ".0" of a number goes, a check digit stays."""
    return F.nullif(F.regexp_replace(F.regexp_replace(strip(present(x)), r"^(\d+)\.0$", "$1"), "[^0-9]", ""), F.lit(""))


def letter_prefix(key: Column) -> Column:
    return F.nullif(F.regexp_extract(key, "^[a-z]+", 0), F.lit(""))


def last_chars(key: Column, n: int) -> Column:
    """The last n characters; shorter values whole, missing ones null."""
    return F.when(~is_missing(key), F.right(key, F.lit(n)))


def first_code(x: Column) -> Column:
    """The first part of "a;b;c" that isn't blank."""
    parts = F.filter(F.transform(F.split(present(x), ";"), strip), lambda p: p != "")
    return F.try_element_at(parts, F.lit(1))


def leading_code(x: Column) -> Column:
    """The text before the first ";" (null if that is blank, unlike ``first_code``)."""
    return F.nullif(F.trim(F.substring_index(x, ";", 1)), F.lit(""))


def contains_key(text: Column, part: Column) -> Column:
    """Is ``part`` in ``text``?  False if either is missing."""
    return F.coalesce(~is_missing(text) & ~is_missing(part) & F.contains(text, part), F.lit(False))


def description(*parts: Column) -> Column:
    """Up to four parts that are there, joined by " | "; null without any."""
    return F.nullif(F.concat_ws(" | ", *(model_text(p) for p in parts[:4])), F.lit(""))


def key_type(document_type: Column) -> Column:
    """CUDE for event documents, else CUFE."""
    return F.when(F.coalesce(model_text(document_type), F.lit("")).rlike("|".join(EVENT_MARKS)), "CUDE").otherwise("CUFE")


def safe_file_name(path: Column) -> Column:
    """The last segment of a path, with unusual characters replaced, at most 180 characters."""
    return F.right(F.regexp_replace(F.regexp_extract(path, r"[^/\\]*$", 0), r"[^A-Za-z0-9._-]+", "_"), F.lit(180))


def natural_key(code: Column) -> Column:
    """A text that sorts like the code with its digit runs read as numbers; missing codes last."""
    padded = F.transform(F.regexp_extract_all(code, F.lit(r"(\d+|\D+)")), lambda p: F.when(p.rlike(r"^\d"), F.lpad(F.regexp_replace(p, "^0+(?=.)", ""), 20, "0")).otherwise(p))
    return F.when(is_missing(code), F.lit("\uffff")).otherwise(F.array_join(padded, ""))


def fold_header(name: str) -> str:
    """A listing header: damaged characters and marks dropped, other signs to spaces, case folded."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", name.replace("\ufffd", "")) if not unicodedata.combining(c))
    return " ".join("".join(c if c.isalnum() else " " for c in plain).casefold().split())


def fold_ledger_header(name: str) -> str:
    """A ledger header: capital letters and digits only."""
    plain = unicodedata.normalize("NFKD", name).upper()
    return "".join(c for c in plain if c.isascii() and c.isalnum())


def snake_name(name: str) -> str:
    """A column name in snake case."""
    return "_".join("".join(c if c.isascii() else " " for c in fold_header(name)).split())


def tokens(x: Column, stop_words: tuple[str, ...] = (), least: int = 3) -> Column:
    """Lower-case words of letters, without stop words and short ones, in order.  Words are not reduced to lemmas."""
    words = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ")
    keep = lambda w: (F.length(w) >= least) & ~w.rlike(r"^\p{N}+$") & (~w.isin(*stop_words) if stop_words else F.lit(True))
    return F.filter(words, keep)


def first_of(normal: Callable[[Column], Column], *columns: Column) -> Column:
    """The first column that has a value after ``normal``, as for ids and texts that two sources may give."""
    return F.coalesce(*(normal(c) for c in columns))


def stop_words(spark: SparkSession, language: str = "spanish") -> tuple[str, ...]:
    """The stop words of a language that come with Spark."""
    return tuple(spark._jvm.org.apache.spark.ml.feature.StopWordsRemover.loadDefaultStopWords(language))
