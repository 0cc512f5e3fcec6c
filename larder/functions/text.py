"""Text cleaning, assembly and formatting as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.values import bind

# The English stop words of the public NLTK corpus (179 words).
ENGLISH_STOPWORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
    yourselves he him his himself she she's her hers herself it it's its itself they them their
    theirs themselves what which who whom this that that'll these those am is are was were be been
    being have has had having do does did doing a an the and but if or because as until while of at
    by for with about against between into through during before after above below to from up down
    in out on off over under again further then once here there when where why how all any both each
    few more most other some such no nor not only own same so than too very s t can will just don
    don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn
    doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn
    needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
    """.split()
)

# Characters that transliterate to something other than one base letter.
EXPANSIONS = {
    "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "ı": "i",
    "Æ": "AE", "Œ": "OE", "Ø": "O", "Ł": "L", "Đ": "D", "Ð": "D", "Þ": "Th", "ẞ": "Ss",
    "¼": " 1/4 ", "½": " 1/2 ", "¾": " 3/4 ", "°": "deg", "×": "x", "÷": "/", "µ": "u",
    "©": "(c)", "®": "(r)", "™": "(tm)", "ª": "a", "º": "o", "¹": "1", "²": "2", "³": "3",
    "£": "PS", "€": "EUR", "§": "SS", "¶": "P", "–": "-", "—": "--", "‘": "'", "’": "'",
    "“": '"', "”": '"', "…": "...", "«": "<<", "»": ">>", "•": "*", " ": " ",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Latin spelling of Greek and Cyrillic letters.
GREEK = dict(zip("αβγδεζηθικλμνξοπρςστυφχψω", "a b g d e z e th i k l m n x o p r s s t u ph kh ps o".split()))
CYRILLIC = dict(
    zip(
        "абвгдежзийклмнопрстуфхцчшщыэюяіїєґ",
        "a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch y e iu ia i i e g".split(),
    )
) | {"ъ": "", "ь": "", "ё": "e"}
COMBINING = "".join(map(chr, range(0x0300, 0x0370)))


@lru_cache(maxsize=1)
def fold_map() -> dict[str, str]:
    """Letter, ligature or fraction -> Latin spelling, from Unicode decompositions and the two alphabets.

    A combining mark maps to nothing, so a decomposed accent is dropped like a composed one.
    """
    folded = dict.fromkeys(COMBINING, "")
    for letter, base in {**GREEK, **CYRILLIC}.items():
        folded[letter] = base
        if letter.upper() != letter and len(letter.upper()) == 1:
            folded[letter.upper()] = base.capitalize()
    accented = (*range(0x00C0, 0x0250), *range(0x0386, 0x03CF), *range(0x0400, 0x0460), *range(0x1E00, 0x2000))
    for code in accented:
        letter = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(x))
        if base == letter or len(base) != 1:
            continue
        if base.isascii() and base.isalpha():
            folded.setdefault(letter, base)
        elif base in folded:
            folded.setdefault(letter, folded[base])
    for code in (*range(0xFB00, 0xFB07), *range(0x2153, 0x215F)):
        spelled = unicodedata.normalize("NFKD", chr(code)).replace("\u2044", "/")
        folded[chr(code)] = f" {spelled} " if "/" in spelled else spelled
    return folded


def replacements(extra: dict[str, str] | None = None) -> tuple[dict[str, str], dict[str, str]]:
    """Characters replaced by at most one character, and those replaced by more."""
    singles, longer = {}, {}
    for char, repl in {**fold_map(), **EXPANSIONS, **(extra or {})}.items():
        (singles if len(repl) <= 1 else longer)[char] = repl
    # What is deleted comes last: translation has nothing to put in its place.
    return dict(sorted(singles.items(), key=lambda x: not x[1])), longer


@lru_cache(maxsize=16)
def stopwords(language: str = "english") -> tuple[str, ...]:
    """Stop words of a language; languages other than English come with Spark ML."""
    if language == "english":
        return ENGLISH_STOPWORDS
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords(language))


def to_ascii(text: Column | str, extra: dict[str, str] | None = None) -> Column:
    """Transliterate Latin letters and common symbols; other scripts pass through.

    ``extra`` adds or overrides single-character replacements. Texts that are ASCII already, the
    usual case, are recognised by one comparison of byte and character counts and left alone, unless
    ``extra`` replaces ASCII characters.
    """
    c = _col(text)
    return _folded(c, extra) if _replaces_ascii(extra) else F.when(is_ascii(c), c).otherwise(_folded(c, extra))


def _replaces_ascii(extra: dict[str, str] | None) -> bool:
    return any(c.isascii() for c in extra or ())


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def _folded(c: Column, extra: dict[str, str] | None) -> Column:
    singles, longer = replacements(extra)

    def expand(t: Column) -> Column:
        out = t
        for char, repl in longer.items():
            out = F.replace(out, F.lit(char), F.lit(repl))
        return out if _replaces_ascii(extra) else F.when(is_ascii(t), t).otherwise(out)

    return bind(F.translate(c, "".join(singles), "".join(singles.values())), expand)


def collapse_spaces(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(text), r"\s+", " "))


def remove_words(text: Column | str, words: Sequence[str]) -> Column:
    """Drop the given words from a single-spaced text; the membership test is a hash look-up.

    The word list goes into the plan as one SQL lambda, not as one literal column per word.
    """
    listed = ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)
    stays = F.expr(f"t -> t <> '' AND t NOT IN ({listed})")
    return F.array_join(F.call_function("filter", F.split(_col(text), " "), stays), " ")


def clean_text(
    text: Column | str,
    punctuation: bool = True,
    stop: Sequence[str] | None = ENGLISH_STOPWORDS,
    extra: dict[str, str] | None = None,
) -> Column:
    """Lower-case, transliterate, blank punctuation, collapse spaces, drop stop words; null -> ''."""
    raw = F.coalesce(_col(text), F.lit(""))
    lower = F.lower(raw)
    t = _folded(lower, extra) if _replaces_ascii(extra) else F.when(is_ascii(raw), lower).otherwise(_folded(lower, extra))
    t = F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}_]+", " ")) if punctuation else collapse_spaces(t)
    return remove_words(t, stop) if stop else t


def tokens(text: Column | str) -> Column:
    """Whitespace tokens of a text."""
    t = F.trim(F.regexp_replace(F.coalesce(_col(text), F.lit("")), r"\s+", " "))
    return F.filter(F.split(t, " "), lambda x: x != "")


def token_len(text: Column | str) -> Column:
    """Number of whitespace tokens, 0 for null."""

    def count(t: Column) -> Column:
        spaces = F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit("")))
        return F.when(t == "", F.lit(0)).otherwise(spaces + 1)

    return bind(collapse_spaces(F.coalesce(_col(text), F.lit(""))), count)


def join_text_list(objs: Column | str) -> Column:
    """Join the non-null ``text`` of an array of structs by one space; null array -> ''."""
    texts = F.filter(F.transform(_col(objs), lambda x: x["text"]), lambda t: t.isNotNull())
    return F.coalesce(F.array_join(texts, " "), F.lit(""))


def join_text_list_stripped(objs: Column | str) -> Column:
    texts = F.filter(F.transform(_col(objs), lambda x: F.trim(x["text"])), lambda t: t.isNotNull())
    return F.coalesce(F.array_join(texts, " "), F.lit(""))


def first_filled(*options: Column | str) -> Column:
    """First option that is neither null nor empty, else ''."""
    return F.coalesce(*[bind(_col(o), lambda t: F.when(t != "", t)) for o in options], F.lit(""))


def document_text(title: Column | str, ingredients: Column | str, instructions: Column | str) -> Column:
    """Labelled lines joined by newline, empty parts left out."""
    parts = (("title: ", title), ("ingredients: ", ingredients), ("instructions: ", instructions))
    lines = [F.when(_col(c) != "", F.concat(F.lit(label), _col(c))) for label, c in parts]
    return F.trim(F.concat_ws("\n", *lines))


def document_section(document: Column | str, label: str) -> Column:
    """Text of the line starting with ``<label>:``, trimmed; '' when there is none."""
    return F.trim(F.regexp_extract(_col(document), rf"(?m)^{label}:(.*)$", 1))


def snippet(text: Column | str, size: int = 200) -> Column:
    c = _col(text)
    return F.when(F.length(c) > size, F.concat(F.left(c, F.lit(size)), F.lit(" ..."))).otherwise(c)


def preview(text: Column | str, width: int = 180) -> Column:
    """Collapse spaces and cut at the last word or hyphen boundary that leaves room for ``…``."""
    t = collapse_spaces(text)
    room = width - 1
    letter = r"[^\P{L}]"
    cut = F.regexp_extract(
        t,
        rf"^(.{{0,{room}}}(?:(?=\s|$)|(?<={letter}{{2}}-)(?={letter}-?{letter})))",
        1,
    )
    return F.when(F.length(t) <= width, t).otherwise(F.concat(cut, F.lit("…")))


def _rounded(v: Column, digits: int) -> Column:
    """Nearest multiple of ``10**-digits`` to the exact binary value, exact halves to even.

    The scaled product is rounded by the hardware; splitting the value in two halves of 26 bits gives
    the error of that product, which settles values that look like a half but are not.
    """
    scale = 10.0**digits
    size = F.abs(v)
    scaled, shifted = size * scale, size * F.lit(134217729.0)
    high = shifted - (shifted - size)
    error = (high * scale - scaled) + (size - high) * scale
    whole = F.floor(scaled).cast("double")
    rest = scaled - whole
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (F.floor(scaled) % 2 == 1))))
    nearest = (whole + F.when(up, 1.0).otherwise(0.0)) / scale
    return F.when(size < 1e12, F.when(v < 0, -nearest).otherwise(nearest)).otherwise(v)


def fixed(value: Column | str, digits: int) -> Column:
    """Fixed-point text, correctly rounded; null stays null."""
    v = bind(_col(value).cast("double"), lambda x: _rounded(x, digits))
    return F.when(_col(value).isNotNull(), F.format_string(f"%.{digits}f", v))


def percent(part: Column, whole: Column) -> Column:
    """``"12.34%"``, or ``"0%"`` when the whole is 0."""
    rate = F.try_divide(part.cast("double"), whole.cast("double")) * 100
    return F.coalesce(F.concat(fixed(rate, 2), F.lit("%")), F.lit("0%"))


def colour_badge(colour: Column | str) -> Column:
    """Traffic-light symbol of a colour name; null or unknown is white."""
    # Colour names and their symbols.
    badges = {"green": "🟢", "orange": "🟠", "red": "🔴"}
    lookup = F.create_map(*[F.lit(x) for pair in badges.items() for x in pair])
    return F.coalesce(F.element_at(lookup, _col(colour)), F.lit("⚪"))
