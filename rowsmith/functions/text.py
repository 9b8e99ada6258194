"""Text rules as native column expressions (no Python in the row path)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space, as a space look-alike, as invisible.
# \p{Z} holds the blank, U+00A0, U+1680, U+2000-200A, U+2028, U+2029, U+202F, U+205F and U+3000.
WS = r"[\s\x{0B}\p{Z}\x{FEFF}]"
NON_WS = r"[^\s\x{0B}\p{Z}\x{FEFF}]"
WS_CHARS = "\t\n\x0b\x0c\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
SPACE_LIKE = r"[\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
ZERO_WIDTH = r"[\x{200B}-\x{200D}\x{FEFF}]"
INVISIBLE = r"[\x{00A0}\x{1680}\x{2000}-\x{200D}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
# Patterns for a word character, a tallied word and a number with grouping commas.
WORD_CHAR = r"[\p{L}\p{M}\p{N}_]"
TALLY_WORD = r"[\p{L}\p{M}\p{N}']+"
NUMBER = r"-?(?:\d{1,2}(?:,\d\d)+,\d{3}|\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?"

# Patterns for the end of a sentence, the gap between paragraphs, runs of
# blank lines, a hyphen at a line end, and the seams of an identifier.
SENTENCE_END = r"[.!?]+(?=" + WS + r"|\z)|\n+"
PARAGRAPH_GAP = r"\n" + WS + r"*\n"
BLANK_RUN = r"\n{3,}"
BLOCK_GAP = r"\n[ \t]*\n+"
LINE_END_HYPHEN = r"(\w)-\n(\w)"
ACRONYM_SEAM, CAMEL_SEAM = r"([A-Z]+)([A-Z][a-z])", r"([a-z0-9])([A-Z])"
APOSTROPHE, NOT_WORD = r"['\x{2019}]", r"[^\p{L}\p{M}\p{N}]+"

# Words too common to be interesting, and words a title keeps small.
STOP_WORDS = "the a an and or but if of to in on at for with is are was were be been it this that as by from".split()
SMALL_WORDS = "a an and as at but by for in nor of on or the to up via".split()
READING_WORDS_PER_MINUTE = 225


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Numbers added up one after another; beyond that a list is cut into blocks of as many.
SUM_BLOCK = 16


def running_sums(numbers: Column) -> Column:
    """Sum of each number of an array and those before it, as an array.

    Blocks of SUM_BLOCK are summed one number after another, what lies before a block by doubling the reach, so a list of n
    numbers takes about n copies and additions (n / SUM_BLOCK * log n for the blocks), never one copy of the list per number.
    """

    def along(block: Column) -> Column:
        return F.aggregate(block, F.array().cast("array<bigint>"), lambda done, x: F.array_append(done, F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0).cast("long")) + x))

    def before(totals: Column) -> Column:
        rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(totals).cast("double"))).cast("int"))
        reached = F.aggregate(
            rounds, totals, lambda sums, k: F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - F.call_function("shiftleft", F.lit(1), k)), F.lit(0)))
        )
        return F.zip_with(reached, totals, lambda upto, own: upto - own)

    def joined(blocks: Column) -> Column:
        whole = F.array(F.transform(blocks, lambda b: F.element_at(b, -1)))
        first = F.element_at(F.transform(whole, before), 1)
        return F.flatten(F.zip_with(blocks, first, lambda block, start: F.transform(block, lambda x: x + start)))

    def cut(values: Column) -> Column:
        number = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / SUM_BLOCK).cast("int"))
        blocks = F.transform(number, lambda b: along(F.slice(values, b * SUM_BLOCK + 1, F.lit(SUM_BLOCK))))
        return F.element_at(F.transform(F.array(blocks), joined), 1)

    # Each list is named once here and handed on, so that it is not made again for every number.
    once = lambda values: F.when(F.size(values) <= SUM_BLOCK, along(values)).otherwise(cut(values))
    return F.element_at(F.transform(F.array(numbers), once), 1)


def unify_newlines(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), r"\r\n?", "\n")


def js_trim(text: Column | str) -> Column:
    return F.btrim(_col(text), F.lit(WS_CHARS))


def has_ink(text: Column | str) -> Column:
    """True when something other than white space is there."""
    return _col(text).rlike(NON_WS)


def split_lines(text: Column | str) -> Column:
    """Ordered lines; no lines at all for an empty text."""
    clean = unify_newlines(text)
    return F.when(clean != "", F.split(clean, "\n", -1)).otherwise(F.array().cast("array<string>"))


def word_count(text: Column | str) -> Column:
    """Pieces between white space that hold a letter or digit: each is met at its first one."""
    return F.regexp_count(_col(text), F.lit(rf"[\p{{L}}\p{{N}}]{NON_WS}*+")).cast("long")


def sentence_pieces(text: Column | str) -> Column:
    pieces = F.split(_col(text), SENTENCE_END, -1)
    return F.filter(pieces, has_ink)


def sentence_count(text: Column | str) -> Column:
    return F.size(sentence_pieces(text)).cast("long")


def paragraph_count(text: Column | str) -> Column:
    pieces = F.split(_col(text), PARAGRAPH_GAP, -1)
    return F.size(F.filter(pieces, has_ink)).cast("long")


def solid_length(text: Column | str) -> Column:
    return (F.length(_col(text)) - F.regexp_count(_col(text), F.lit(WS))).cast("long")


def reading_label(words: Column) -> Column:
    minutes = words / F.lit(READING_WORDS_PER_MINUTE)
    return (
        F.when(words == 0, "0m")
        .when(minutes < 1, "<1m")
        .otherwise(F.concat(F.floor(minutes + 0.5).cast("string"), F.lit("m")))
    )


def tally_words(text: Column | str) -> Column:
    """Lower-cased words worth counting, in text order, repeats kept."""
    words = F.regexp_extract_all(F.lower(_col(text)), F.lit(TALLY_WORD), F.lit(0))
    return F.filter(words, lambda w: (F.length(w) >= 3) & ~w.isin(STOP_WORDS))


def commonest(words: Column, k: int) -> Column:
    """The ``k`` commonest of a list of words, as (word, n); ties go to the word met first. One sort, inside the row."""

    def counted(ordered: Column) -> Column:
        word = lambda at: F.get(ordered, at)["word"]
        places = F.when(F.size(ordered) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.size(ordered) - 1))
        starts = F.filter(places, lambda at: (at == 0) | (word(at) != word(at - 1)))
        return F.element_at(F.transform(F.array(starts), lambda s: tallied(ordered, s)), 1)

    def tallied(ordered: Column, starts: Column) -> Column:
        # Sorted by falling count, then by first place; the word is read off the place it starts at.
        entry = lambda at, i: F.struct((at - F.coalesce(F.get(starts, i + 1), F.size(ordered))).alias("less"), F.get(ordered, at)["pos"].alias("pos"), at.alias("at"))
        best = F.slice(F.sort_array(F.transform(starts, entry)), 1, k)
        return F.transform(best, lambda e: F.struct(F.get(ordered, e["at"])["word"].alias("word"), (-e["less"]).cast("long").alias("n")))

    placed = F.sort_array(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("pos"))))
    return F.element_at(F.transform(F.array(placed), counted), 1)


def line_key(line: Column | str, ignore_case: bool = True, trim: bool = True) -> Column:
    key = js_trim(line) if trim else _col(line)
    return F.lower(key) if ignore_case else key


def natural_key(line: Column | str, ignore_case: bool = True) -> Column:
    """Sort key under which "item2" comes before "item10".

    Every run of digits gets its length in front (ten places), leading zeros dropped,
    so plain string order compares the numbers by size.
    """
    text = F.lower(_col(line)) if ignore_case else _col(line)
    marked = F.regexp_replace(text, r"0*(\d+)", "\x01$1\x02")
    parts = F.split(marked, "\x01", -1)

    def padded(part: Column) -> Column:
        digits = F.substring_index(part, "\x02", 1)
        rest = F.substring(part, F.length(digits) + F.lit(2), F.length(part))
        return F.when(
            F.instr(part, "\x02") > 0,
            F.concat(F.lpad(F.length(digits).cast("string"), 10, "0"), digits, rest),
        ).otherwise(part)

    numbered = F.array_join(F.transform(parts, padded), "")
    return F.when(text.rlike("[0-9]"), numbered).otherwise(text)


def first_number(line: Column | str) -> Column:
    """The first number on the line, grouping commas removed; NULL when there is none."""
    found = F.regexp_extract(_col(line), NUMBER, 0)
    return F.replace(found, F.lit(","), F.lit("")).try_cast("double")


def collapse_blank_runs(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), BLANK_RUN, "\n\n")


def normalise_whitespace(
    text: Column | str,
    invisible: bool = True,
    tabs: bool = True,
    collapse: bool = True,
    trim_lines: bool = True,
    blank_lines: bool = False,
    drop_all: bool = False,
) -> Column:
    out = unify_newlines(text)
    if invisible:
        out = F.regexp_replace(F.regexp_replace(out, ZERO_WIDTH, ""), SPACE_LIKE, " ")
    if drop_all:
        out = F.regexp_replace(out, r"[ \t]+", "")
    else:
        if tabs:
            out = F.translate(out, "\t", " ")
        if collapse:
            out = F.regexp_replace(out, r"[ \t]{2,}", " ")
        if trim_lines:
            out = F.regexp_replace(F.regexp_replace(out, r"[ \t]+(\n|\z)", "$1"), r"(\n|\A)[ \t]+", "$1")
    if blank_lines:
        out = F.array_join(F.filter(F.split(out, "\n", -1), has_ink), "\n")
    return out


def unwrap_lines(
    text: Column | str,
    sep: str = " ",
    keep_paragraphs: bool = True,
    trim: bool = True,
    dehyphen: bool = False,
) -> Column:
    out = unify_newlines(text)
    if dehyphen:
        out = F.regexp_replace(out, LINE_END_HYPHEN, "$1$2")

    def joined(block: Column) -> Column:
        lines = F.split(block, "\n", -1)
        if trim:
            lines = F.transform(lines, js_trim)
        return F.array_join(F.filter(lines, lambda line: line != ""), sep)

    if not keep_paragraphs:
        return joined(out)
    blocks = F.transform(F.split(out, BLOCK_GAP, -1), joined)
    return F.array_join(F.filter(blocks, lambda b: b != ""), "\n\n")


def drop_blank_lines(text: Column | str) -> Column:
    return F.array_join(F.filter(F.split(unify_newlines(text), "\n", -1), has_ink), "\n")


# The edge of an ASCII word, spelt out: what \b means differs between Java versions.
ASCII_EDGE = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"


def search_pattern(needle: str, regex: bool = False, case: bool = False, word: bool = False) -> str:
    """The pattern for a needle; plain text matches itself, a whole word has edges in any alphabet."""
    if regex:
        source = re.sub(r"(?<!\\)((?:\\\\)*)\\b", lambda m: m.group(1) + ASCII_EDGE, needle)
    else:
        # Quoted as a whole; an end mark inside the needle is put between two quotes.
        source = r"\Q" + needle.replace(r"\E", r"\E\\E\Q") + r"\E"
    if word:
        source = f"(?<!{WORD_CHAR})(?:{source})(?!{WORD_CHAR})"
    return source if case else f"(?iu){source}"


def literal_replacement(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


def to_words(text: Column | str) -> Column:
    out = F.regexp_replace(F.regexp_replace(_col(text), ACRONYM_SEAM, "$1 $2"), CAMEL_SEAM, "$1 $2")
    pieces = F.split(F.lower(F.regexp_replace(out, APOSTROPHE, "")), NOT_WORD, -1)
    return F.filter(pieces, lambda w: w != "")


def capitalise(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, 2, 2_147_483_647))


def recase(text: Column | str, style: str) -> Column:
    """upper, lower, title, sentence, camel, snake, kebab or alternate."""
    c = _col(text)
    if style == "upper":
        return F.upper(c)
    if style == "lower":
        return F.lower(c)
    if style == "snake":
        return F.array_join(to_words(c), "_")
    if style == "kebab":
        return F.array_join(to_words(c), "-")
    if style == "camel":
        return F.array_join(F.transform(to_words(c), lambda w, i: F.when(i == 0, w).otherwise(capitalise(w))), "")
    if style == "title":
        return F.array_join(F.transform(F.split(c, "\n", -1), _title_line), "\n")
    if style == "sentence":
        low = F.lower(c)
        # A letter opens a sentence at the start of the text or of a line, or after an end mark and a space.
        marked = F.regexp_replace(low, r"(?:\A|(?<=[.!?]\s)|(?<=\n))\s*+(?=[a-z])", "$0\x01")
        parts = F.split(marked, "\x01", -1)
        return F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(capitalise(p))), "")
    if style == "alternate":
        # Split before every ASCII letter: piece k (k >= 1) starts with letter number k.
        parts = F.split(F.regexp_replace(c, r"([A-Za-z])", "\x01$1"), "\x01", -1)

        def cased(p: Column, i: Column) -> Column:
            first, rest = F.substring(p, 1, 1), F.substring(p, 2, 2_147_483_647)
            return (
                F.when(i == 0, p)
                .when(i % 2 == 1, F.concat(F.lower(first), rest))
                .otherwise(F.concat(F.upper(first), rest))
            )

        return F.array_join(F.transform(parts, cased), "")
    raise ValueError(f"unknown style {style!r}")


def _title_line(line: Column) -> Column:
    low = F.lower(line)
    # Gaps are kept by marking the start of every word instead of splitting on spaces.
    words = F.split(F.regexp_replace(low, r"(\S+)", "\x01$1"), "\x01", -1)
    last = F.size(words) - 1

    def cased(chunk: Column, i: Column) -> Column:
        bare = F.regexp_replace(chunk, r"\s+\z", "")
        small = bare.isin(SMALL_WORDS) & (i > 1) & (i < last)
        return F.when((i == 0) | small, chunk).otherwise(capitalise(chunk))

    return F.array_join(F.transform(words, cased), "")


# Accented Latin letters and the plain letter a slug uses instead.
ACCENTED = "àáâãäåāçćčèéêëēìíîïīñńòóôõöōøùúûüūýÿžźżšśß"
PLAIN = "aaaaaaaccceeeeeiiiiinnooooooouuuuuyyzzzsss"


def slug(text: Column | str) -> Column:
    plain = F.translate(F.lower(_col(text)), ACCENTED, PLAIN)
    return F.regexp_replace(F.regexp_replace(plain, r"[^a-z0-9]+", "-"), r"\A-+|-+\z", "")


# Entities and the characters they stand for.
ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&", "nbsp": "\u00a0", "copy": "©", "reg": "®", "trade": "™", "middot": "·",
    "bull": "•", "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "sbquo": "‚", "ldquo": "“", "rdquo": "”", "bdquo": "„",
    "laquo": "«", "raquo": "»", "euro": "€", "pound": "£", "yen": "¥", "cent": "¢", "sect": "§", "para": "¶", "deg": "°", "plusmn": "±",
    "times": "×", "divide": "÷", "frac12": "½", "frac14": "¼", "frac34": "¾", "sup2": "²", "sup3": "³", "micro": "µ", "minus": "−", "larr": "←",
    "rarr": "→", "uarr": "↑", "darr": "↓", "szlig": "ß", "agrave": "à", "aacute": "á", "acirc": "â", "atilde": "ã", "auml": "ä", "aring": "å",
    "aelig": "æ", "ccedil": "ç", "egrave": "è", "eacute": "é", "ecirc": "ê", "euml": "ë", "igrave": "ì", "iacute": "í", "icirc": "î", "iuml": "ï",
    "ntilde": "ñ", "ograve": "ò", "oacute": "ó", "ocirc": "ô", "otilde": "õ", "ouml": "ö", "oslash": "ø", "ugrave": "ù", "uacute": "ú", "ucirc": "û",
    "uuml": "ü", "Auml": "Ä", "Ouml": "Ö", "Uuml": "Ü", "Eacute": "É", "Ntilde": "Ñ", "shy": "\u00ad", "zwnj": "\u200c", "zwj": "\u200d",
}


def _code_point(digits: Column, base: int) -> Column:
    """The character of a number; a number that is none, or half of a pair, is U+FFFD."""
    n = F.conv(digits, base, 10).cast("long")
    good = ((n > 0) & (n < 0xD800)) | ((n > 0xDFFF) & (n <= 0x10FFFF))
    return F.decode(F.unhex(F.lpad(F.hex(F.when(good, n).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")


def unescape_html(text: Column | str) -> Column:
    """Entities decoded once, by name or by number; what is no entity stays."""
    known = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])

    def piece(part: Column, i: Column) -> Column:
        """What follows an ampersand."""
        name = F.substring_index(part, ";", 1)
        ended = F.contains(part, F.lit(";")) & (F.length(name) <= 8)
        decimal, hexadecimal = name.rlike(r"\A#[0-9]{1,7}\z"), name.rlike(r"\A#[xX][0-9A-Fa-f]{1,6}\z")
        char = (
            F.when(ended & decimal, _code_point(F.substr(name, F.lit(2)), 10))
            .when(ended & hexadecimal, _code_point(F.substr(name, F.lit(3)), 16))
            .when(ended, F.try_element_at(known, name))
        )
        rest = F.substr(part, F.length(name) + 2)
        return F.when(i == 0, part).otherwise(F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), part)))

    whole = _col(text)
    decoded = F.array_join(F.transform(F.split(whole, "&"), piece), "")
    return F.when(F.contains(whole, F.lit("&")), decoded).otherwise(whole)


def escape_html(text: Column | str) -> Column:
    out = _col(text)
    # What an escaped text may not hold raw; the ampersand goes first.
    for raw, safe in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")]:
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def html_to_text(html: Column | str) -> Column:
    out = F.regexp_replace(_col(html), r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    out = unescape_html(F.regexp_replace(out, r"<[^>]*>", " "))
    return F.regexp_replace(F.regexp_replace(out, f"{WS}+", " "), r"\A +| +\z", "")


def squeeze_html(html: Column | str) -> Column:
    """Comments and the gaps between tags removed."""
    out = F.regexp_replace(_col(html), r"(?s)<!--.*?-->", "")
    return F.regexp_replace(out, r">\s+<", "><")


def syllables(text: Column | str) -> Column:
    """Runs of vowels, at least one per word."""
    words = F.regexp_extract_all(F.lower(_col(text)), F.lit(r"[\p{L}]+"), F.lit(0))
    per_word = F.transform(words, lambda w: F.greatest(F.lit(1), F.regexp_count(w, F.lit(r"[aeiouyàâäéèêëíîïóôöúùûü]+"))))
    return F.aggregate(per_word, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
