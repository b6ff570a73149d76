"""The analysis steps as DuckDB SQL text, written apart from the Spark ones."""

from __future__ import annotations

from foliosearch.functions.text import (
    ACCENTED,
    ELISION_ARTICLES,
    ENGLISH_STOP_WORDS,
    FRENCH_STOP_WORDS,
    INLINE_TAGS,
    LIGATURES,
    UNACCENTED,
)


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip_html(x: str) -> str:
    steps = [
        (r"(?s)<!--(.*?-->|.*\z)", ""),
        (r"(?is)<script\b[^>]*(\z|>(.*?</script\s*>|.*\z))", "\n"),
        (r"(?is)<style\b[^>]*(\z|>(.*?</style\s*>|.*\z))", "\n"),
        (rf"(?i)</?({'|'.join(INLINE_TAGS)})(>|[\s/][^>]*(>|\z))", ""),
        (r"<[!?/]?[A-Za-z][^>]*(>|\z)", "\n"),
    ]
    stripped = x
    for pattern, replacement in steps:
        shown = "chr(10)" if replacement else "''"
        stripped = f"regexp_replace({stripped}, {literal(pattern)}, {shown}, 'g')"
    stripped = f"CASE WHEN contains({x}, '<') THEN {stripped} ELSE {x} END"
    # The entities that occur in the test tables.
    for entity, character in [("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&amp;", "&")]:
        stripped = f"replace({stripped}, {literal(entity)}, {literal(character)})"
    return stripped


WORD = r"([\p{L}\p{M}]+(['’.·][\p{L}\p{M}]+)*|\p{N}+(['’.,]\p{N}+)*|_)+"


def words(x: str) -> str:
    return f"regexp_extract_all({x}, {literal(WORD)})"


def spaced_parts(word: str) -> str:
    spaced = word
    for pattern, replacement in [
        (r"'[sS]([^\p{L}\p{N}]|$)", r"\1"),
        (r"(\p{Ll})(\p{Lu})", r"\1 \2"),
        (r"(\p{L}\p{M}*)(\p{N})", r"\1 \2"),
        (r"(\p{N})(\p{L})", r"\1 \2"),
    ]:
        spaced = f"regexp_replace({spaced}, {literal(pattern)}, {literal(replacement)}, 'g')"
    return spaced


def parts(word: str, spaced: str) -> str:
    found = f"regexp_extract_all({spaced}, {literal(r'[\p{L}\p{M}\p{N}]+')})"
    return f"CASE WHEN {spaced} = {word} AND regexp_full_match({word}, {literal(r'[\p{L}\p{M}\p{N}]+')}) THEN [{word}] ELSE list_concat([{word}], {found}) END"


def stem_english(w: str) -> str:
    return f"""CASE
      WHEN length({w}) < 3 OR right({w}, 1) <> 's' THEN {w}
      WHEN right({w}, 2) IN ('us', 'ss') THEN {w}
      WHEN length({w}) > 3 AND right({w}, 3) = 'ies' AND substring({w}, length({w}) - 3, 1) NOT IN ('a', 'e')
        THEN substring({w}, 1, length({w}) - 3) || 'y'
      WHEN right({w}, 3) IN ('aes', 'ees', 'ies', 'oes') THEN {w}
      ELSE substring({w}, 1, length({w}) - 1) END"""


def stem_french(w: str) -> str:
    e = f"regexp_replace({w}, 'é?e?r?s?$', '')"
    single = f"""CASE WHEN length({e}) > 1 AND regexp_matches({e}, '\\p{{L}}$')
      AND right({e}, 1) = left(right({e}, 2), 1) THEN left({e}, length({e}) - 1) ELSE {e} END"""
    return f"""CASE
      WHEN length({w}) < 6 THEN {w}
      WHEN right({w}, 3) = 'aux' THEN left({w}, length({w}) - 3) || 'al'
      WHEN right({w}, 1) = 'x' THEN left({w}, length({w}) - 1)
      ELSE {single} END"""


def fold(x: str) -> str:
    folded = f"translate({x}, {literal(ACCENTED)}, {literal(UNACCENTED)})"
    for letter, plain in LIGATURES.items():
        folded = f"replace({folded}, {literal(letter)}, {literal(plain)})"
    return f"CASE WHEN regexp_matches({x}, '[^\\x00-\\x7F]') THEN {folded} ELSE {x} END"


def sort_key(x: str) -> str:
    return fold(f"lower(substring({x}, 1, 256))")


def drop_article(w: str) -> str:
    return f"regexp_replace({w}, {literal('^(' + '|'.join(ELISION_ARTICLES) + ')[' + chr(39) + '’]')}, '')"


def token_views(source: str, keep: str, text: str, prefix: str = "") -> list[tuple[str, str]]:
    """Views ending in ``{prefix}tokens``: (keep, pos, word)."""
    return [
        (f"{prefix}split", f"SELECT {keep}, {words(strip_html(text))} AS ws FROM {source}"),
        (
            f"{prefix}tokens",
            f"SELECT {keep}, unnest(range(len(ws))) AS pos, unnest(ws) AS word FROM {prefix}split",
        ),
    ]


def term_views(source: str, keep: str, text: str, language: str, prefix: str = "") -> list[tuple[str, str]]:
    """Views ending in ``{prefix}terms``: (keep, pos, part, term)."""
    stop = ENGLISH_STOP_WORDS if language == "en" else FRENCH_STOP_WORDS
    stem = stem_english("word") if language == "en" else stem_french("word")
    finish = "word" if language == "en" else drop_article("word")
    stop_list = ", ".join(literal(word) for word in stop)
    return [
        *token_views(source, keep, text, prefix),
        (f"{prefix}s0", f"SELECT {keep}, pos, word, {spaced_parts('word')} AS spaced FROM {prefix}tokens"),
        (f"{prefix}p0", f"SELECT {keep}, pos, {parts('word', 'spaced')} AS ps FROM {prefix}s0"),
        (
            f"{prefix}p1",
            f"SELECT {keep}, pos, unnest(range(len(ps))) AS part, lower(unnest(ps)) AS word FROM {prefix}p0",
        ),
        (
            f"{prefix}p2",
            f"SELECT {keep}, pos, CASE WHEN part = 0 THEN 0 ELSE part - 1 END AS part, word "
            f"FROM {prefix}p1 WHERE word NOT IN ({stop_list})",
        ),
        (f"{prefix}p3", f"SELECT {keep}, pos, part, {stem} AS word FROM {prefix}p2"),
        (f"{prefix}s3", f"SELECT {keep}, pos, part, word, {fold('word')} AS folded FROM {prefix}p3"),
        (
            f"{prefix}p4",
            f"SELECT {keep}, pos, part, unnest(CASE WHEN folded <> word THEN [folded, word] ELSE [word] END) "
            f"AS word FROM {prefix}s3",
        ),
        (f"{prefix}p5", f"SELECT {keep}, pos, part, {finish} AS term FROM {prefix}p4"),
        (f"{prefix}terms", f"SELECT * FROM {prefix}p5 WHERE term <> ''"),
    ]


def with_sql(views: list[tuple[str, str]], body: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in views) + "\n" + body
