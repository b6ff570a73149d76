"""Text steps: HTML stripping, words, stems, folding, paths and dates.

Each function takes and returns a Spark column, so that the same step serves a
plain column, an exploded token and a value inside a higher-order function.
"""

from __future__ import annotations

import html.entities
import unicodedata
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliosearch import model as m

# ---------------------------------------------------------------------------
# They must equal those of the analyzers we are compatible with.
# ---------------------------------------------------------------------------

ELISION_ARTICLES = ["c", "l", "m", "t", "qu", "n", "s", "j", "d"]

PATH_DELIMITER = "/"

ENGLISH_STOP_WORDS = """
a an and are as at be but by for if in into is it no not of on or such that the
their then there these they this to was will with
""".split()

# Spark's own French stop words, fixed here so that results do not follow a
# Spark upgrade.
FRENCH_STOP_WORDS = """
au aux avec ce ces dans de des du elle en et eux il je la le les leur lui ma
mais me même mes moi mon ne nos notre nous on ou par pas pour qu que qui sa se
ses son sur ta te tes toi ton tu un une vos votre vous c d j l à m n s t y été
étée étées étés étant étante étants étantes suis es est sommes êtes sont serai
seras sera serons serez seront serais serait serions seriez seraient étais
était étions étiez étaient fus fut fûmes fûtes furent sois soit soyons soyez
soient fusse fusses fût fussions fussiez fussent ayant ayante ayantes ayants eu
eue eues eus ai as avons avez ont aurai auras aura aurons aurez auront aurais
aurait aurions auriez auraient avais avait avions aviez avaient eut eûmes eûtes
eurent aie aies ait ayons ayez aient eusse eusses eût eussions eussiez eussent
""".split()

# HTML tags that sit inside a word or line: dropped without leaving a space.
INLINE_TAGS = """
a abbr acronym b basefont bdo big cite code dfn em font i img input kbd label q
s samp select small span strike strong sub sup textarea tt u var
""".split()

# ---------------------------------------------------------------------------


def strip_html(text: Column) -> Column:
    """Text without comments, script and style bodies and tags, entities decoded.

    Text without any markup or entity passes untouched.  What opens and never
    ends (a comment, a body, a tag) takes the rest of the text, as a browser
    reads it; so no pattern looks for the same end twice, and time grows with
    the length of the text alone.
    """
    stripped = F.regexp_replace(text, r"(?s)<!--(?:.*?-->|.*\z)", "")
    stripped = F.regexp_replace(stripped, r"(?is)<script\b[^>]*(?:\z|>(?:.*?</script\s*>|.*\z))", "\n")
    stripped = F.regexp_replace(stripped, r"(?is)<style\b[^>]*(?:\z|>(?:.*?</style\s*>|.*\z))", "\n")
    inline = "|".join(INLINE_TAGS)
    stripped = F.regexp_replace(stripped, rf"(?i)</?(?:{inline})(?:>|[\s/][^>]*(?:>|\z))", "")
    stripped = F.regexp_replace(stripped, r"<[!?/]?[A-Za-z][^>]*(?:>|\z)", "\n")
    stripped = F.when(F.contains(text, F.lit("<")), stripped).otherwise(text)
    return F.when(F.contains(text, F.lit("&")), decode_entities(stripped)).otherwise(stripped)


def _named_entities() -> Column:
    """The named HTML 4 entities as one constant map."""
    codes = html.entities.name2codepoint
    pairs = "\n".join(f"{name}={chr(code)}" for name, code in codes.items())
    return F.str_to_map(F.lit(pairs), F.lit("\n"), F.lit("="))


def _character(code_point: Column) -> Column:
    """The character of a code point, built from its UTF-32 bytes."""
    return F.decode(F.unhex(F.lpad(F.hex(code_point), 8, "0")), "UTF-32")


def decode_entities(text: Column) -> Column:
    """Named, decimal and hexadecimal character references decoded, once each.

    The ampersand comes last, so that ``&amp;lt;`` ends as ``&lt;``.
    """
    reference = r"&(?:[A-Za-z][A-Za-z0-9]*|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});"
    ampersand = r"&(?:amp|#0*38|#[xX]0*26);"
    names = _named_entities()

    def apply(acc: Column, entity: Column) -> Column:
        body = F.regexp_replace(entity, "[&;]", "")
        code = F.when(
            body.rlike("^#[xX]"), F.conv(F.regexp_replace(body, "^#[xX]", ""), 16, 10).cast("long")
        ).when(body.startswith("#"), F.regexp_replace(body, "#", "").cast("long"))
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        value = F.when(code.isNull(), F.try_element_at(names, body)).when(valid, _character(code))
        keep = F.when(entity.rlike(ampersand), entity)
        return F.replace(acc, entity, F.coalesce(keep, value, entity))

    found = F.array_distinct(F.regexp_extract_all(text, F.lit(reference), F.lit(0)))
    return F.regexp_replace(F.reduce(found, text, apply), ampersand, "&")


def words(text: Column) -> Column:
    """The words of a text as an array.

    A word is a run of letters, digits and underscores.  An apostrophe, full
    stop or middle dot between two letters, and an apostrophe, full stop or
    comma between two digits, do not end it.  Every quantifier is possessive:
    no input can make the matcher backtrack or recurse.
    """
    return F.regexp_extract_all(
        text,
        F.lit(
            r"(?:[\p{L}\p{M}]++(?:['’.·][\p{L}\p{M}]++)*+"
            r"|\p{N}++(?:['’.,]\p{N}++)*+"
            r"|_)++"
        ),
        F.lit(0),
    )


# A word in one piece: most words are, and this is seen in one pass over the letters.
_ONE_PIECE = r"^\p{Lu}?+\p{Ll}++$"

# Where a word falls into parts.
_PART_BREAK = r"[^\p{L}\p{M}\p{N}]|\p{Ll}\p{Lu}|\p{L}\p{M}*\p{N}|\p{N}\p{L}"


def with_word_parts(word: Column) -> Column:
    """A word and its parts: ``[word]``, or ``[word, part, part, …]``.

    Parts end at punctuation, at a lower-to-upper case change and between
    letters and digits; a possessive ``'s`` is dropped from them.  Most words
    have no parts and cost a single short match.
    """
    spaced = F.regexp_replace(word, r"'[sS]([^\p{L}\p{N}]|$)", "$1")
    spaced = F.regexp_replace(spaced, r"(\p{Ll})(\p{Lu})", "$1 $2")
    spaced = F.regexp_replace(spaced, r"(\p{L}\p{M}*)(\p{N})", "$1 $2")
    spaced = F.regexp_replace(spaced, r"(\p{N})(\p{L})", "$1 $2")
    parts = F.array_remove(F.split(spaced, r"[^\p{L}\p{M}\p{N}]+"), "")
    whole = word.rlike(_ONE_PIECE) | ~word.rlike(_PART_BREAK)
    return F.when(whole, F.array(word)).otherwise(F.concat(F.array(word), parts))


def lowercase(word: Column) -> Column:
    return F.lower(word)


def is_stop_word(word: Column, stop_words: list[str]) -> Column:
    return word.isin(*stop_words)


def _without_last(word: Column, count: int | Column) -> Column:
    return F.left(word, F.length(word) - count)


def stem_english(word: Column) -> Column:
    """Plural stripping (the S-stemmer of Harman, 1991)."""
    keeps = [word.endswith(ending) for ending in ("us", "ss", "aes", "ees", "oes")]
    ies = word.endswith("ies")
    return (
        F.when((F.length(word) < 3) | ~word.endswith("s") | reduce(or_, keeps), word)
        .when(ies & ((F.length(word) == 3) | word.endswith("aies") | word.endswith("eies")), word)
        .when(ies, F.concat(_without_last(word, 3), F.lit("y")))
        .otherwise(_without_last(word, 1))
    )


def _french_ending(word: Column, ending: str = "", letters: str = "sreé") -> Column:
    """How many letters the longest ending ``é?e?r?s?`` of a word has."""
    if not letters:
        return F.lit(len(ending))
    longer = letters[0] + ending
    return F.when(word.endswith(longer), _french_ending(word, longer, letters[1:])).otherwise(
        _french_ending(word, ending, letters[1:])
    )


def stem_french(word: Column) -> Column:
    """Minimal French stemmer (Savoy, 1999): words under six letters stay.

    A word loses a final s, then r, e and é, then one of two equal last letters.
    Every word is asked for its ending, so the endings are compared, not matched: a
    pattern would be tried at each letter of the word.  The ending is named twice at
    most: Java leaves a method uncompiled once its code is too long.
    """
    before = F.substring(word, F.length(word) - _french_ending(word) - 1, F.lit(2))
    doubled = before.rlike(r"^(\p{L})\1$").cast("int")
    return (
        F.when(F.length(word) < 6, word)
        .when(word.endswith("aux"), F.concat(_without_last(word, 3), F.lit("al")))
        .when(word.endswith("x"), _without_last(word, 1))
        .otherwise(_without_last(word, _french_ending(word) + doubled))
    )


def _accent_table() -> tuple[str, str]:
    """Accented Latin letters and the plain letter each one decomposes to."""
    accented, plain = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.isascii() and base.isalpha():
            accented.append(chr(code))
            plain.append(base)
    # Letters and quotes without a decomposition.
    for letter, base in zip("øØđĐðÐłŁħĦıŧŦ‘’‚‛“”„«»–—", "oOdDdDlLhHitT''''\"\"\"\"\"--", strict=True):
        accented.append(letter)
        plain.append(base)
    return "".join(accented), "".join(plain)


ACCENTED, UNACCENTED = _accent_table()

# Letters that fold to more than one.
LIGATURES = {"ß": "ss", "œ": "oe", "æ": "ae", "þ": "th", "Œ": "OE", "Æ": "AE", "Þ": "TH"}


def _is_ascii(text: Column) -> Column:
    """One byte per character."""
    return F.length(text) == F.octet_length(text)


def fold_accents(text: Column) -> Column:
    folded = F.translate(text, ACCENTED, UNACCENTED)
    for letter, plain in LIGATURES.items():
        folded = F.replace(folded, F.lit(letter), F.lit(plain))
    return F.when(_is_ascii(text), text).otherwise(folded)


def with_folded(word: Column) -> Column:
    """A word, preceded by its accent-free form where that differs."""
    folded = F.array_distinct(F.array(fold_accents(word), word))
    return F.when(_is_ascii(word), F.array(word)).otherwise(folded)


def drop_article(word: Column) -> Column:
    """French elision: ``l'arche`` → ``arche``."""
    elided = F.regexp_replace(word, rf"^(?:{'|'.join(ELISION_ARTICLES)})['’]", "")
    return F.when(F.contains(word, F.lit("'")) | F.contains(word, F.lit("’")), elided).otherwise(word)


def path_hierarchy(path: Column) -> Column:
    """``/a/b/c`` → ``[/a, /a/b, /a/b/c]``."""
    steps = F.split(path, PATH_DELIMITER)
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(steps)),
        lambda count: F.array_join(F.slice(steps, F.lit(1), count), PATH_DELIMITER),
    )
    return F.when(path.isNotNull(), F.array_remove(prefixes, ""))


def keyword(value: Column) -> Column:
    """The whole value as one exact term, cut to the keyword length."""
    return F.substring(value, 1, m.KEYWORD_LENGTH)


def sort_key(value: Column) -> Column:
    """The form a title sorts by: cut, lowercase, without accents."""
    return fold_accents(F.lower(keyword(value)))


def parse_date(value: Column) -> Column:
    """A date with optional time; anything else is null, also a time alone."""
    return F.when(value.rlike(r"^\s*[+-]?\d{4}"), F.try_to_timestamp(value))
