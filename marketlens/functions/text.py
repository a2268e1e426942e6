"""Column functions on raw registry text. Everything stays inside the JVM."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlens.schemas import PORTE_LABELS

_SPACES = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Hangul syllables are composed from three ranges by arithmetic (Unicode, section 3.12).
_HANGUL_FIRST, _HANGUL_LAST = 0xAC00, 0xD7A3
_CODE_POINTS = range(0x80, 0x30000)
_MAYBE_SPECIAL = r"[\x{bc}-\x{be}\x{132}-\x{10ffff}]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def strip(c: Column | str) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.btrim(_col(c), F.lit(_SPACES))


def clean_cell(c: Column | str) -> Column:
    """Null to empty, byte-order marks removed, stripped."""
    return strip(F.replace(_text(c), F.lit("\ufeff"), F.lit("")))


@lru_cache(maxsize=1)
def _folding() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition without combining marks, by rule: characters folding
    to one character, those that vanish (at the end, without a target), and the rest."""
    single, gone, several = {}, [], {}
    for code in _CODE_POINTS:
        if 0xD800 <= code <= 0xDFFF or _HANGUL_FIRST <= code <= _HANGUL_LAST:
            continue
        ch = chr(code)
        folded = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
        if folded == ch:
            continue
        if not folded:
            gone.append(ch)
        elif len(folded) == 1:
            single[ch] = folded
        else:
            several[ch] = folded
    return "".join(single) + "".join(gone), "".join(single.values()), several


def _char_class(chars) -> str:
    """A short regular-expression class covering `chars`. Beyond the Latin blocks nearby
    characters share a range, which may take in others: they are left as they are later."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        near = 1 if code < 0x180 else 64
        if ranges and code - ranges[-1][1] <= near:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges) + "]"


def _code_point(n: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(n), 4, "0")), "UTF-16BE")


def _decompose_char(ch: Column) -> Column:
    several = _folding()[2]
    expansions = F.str_to_map(
        F.lit("\x02".join(f"{k}\x01{v}" for k, v in several.items())), F.lit("\x02"), F.lit("\x01")
    )
    index = F.ascii(ch) - F.lit(_HANGUL_FIRST)
    tail = F.pmod(index, F.lit(28))
    hangul = F.concat(
        _code_point(F.lit(0x1100) + F.floor(index / 588)),
        _code_point(F.lit(0x1161) + F.floor(F.pmod(index, F.lit(588)) / 28)),
        F.when(tail > 0, _code_point(F.lit(0x11A7) + tail)).otherwise(F.lit("")),
    )
    return (
        F.when(F.ascii(ch) < 0x80, ch)
        .when(index.between(0, _HANGUL_LAST - _HANGUL_FIRST), hangul)
        .otherwise(F.coalesce(F.try_element_at(expansions, ch), ch))
    )


def fold_accents(c: Column | str) -> Column:
    """NFKD without combining marks."""
    source, target, several = _folding()
    special = _char_class([*several, *map(chr, range(_HANGUL_FIRST, _HANGUL_LAST + 1))])

    text = _col(c)
    # Characters with a longer decomposition are rare; only texts holding one are taken
    # apart. Plain ASCII is left alone, and two ranges rule most other texts out.
    rare = F.regexp_like(text, F.lit(_MAYBE_SPECIAL)) & F.regexp_like(text, F.lit(special))
    apart = F.array_join(F.transform(F.split(text, ""), _decompose_char), "")
    folded = F.translate(F.when(rare, apart).otherwise(text), source, target)
    return F.when(F.length(text) == F.octet_length(text), text).otherwise(folded)


def normalize_text(c: Column | str) -> Column:
    """Strip, upper-case, fold accents, collapse white space; null to empty."""
    return F.regexp_replace(fold_accents(F.upper(strip(_text(c)))), _SPACE_RUN, " ")


def normalize_name(value: str) -> str:
    """`normalize_text` for a column or file name held on the driver."""
    upper = unicodedata.normalize("NFKD", (value or "").strip().upper())
    return " ".join("".join(ch for ch in upper if not unicodedata.combining(ch)).split())


def only_digits(c: Column | str) -> Column:
    return F.regexp_replace(_text(c), r"(?U)\D+", "")


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def parse_br_number(c: Column | str, style: str = "br") -> Column:
    """Brazilian number text to double, null when it is not a number or more than a double holds.

    "br" drops every point and reads the comma as the decimal mark. "auto" does so only
    where a comma or several points occur, so that `74500.10` keeps its value."""
    text = _col(c)
    plain = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    if style == "auto":
        dotted = ~text.contains(",") & (F.length(text) - F.length(F.replace(text, F.lit("."), F.lit(""))) == 1)
        plain = F.when(dotted, text).otherwise(plain)
    elif style != "br":
        raise ValueError(f"unknown number style {style!r}")
    value = F.when(plain.rlike(_NUMBER), plain.try_cast("double"))
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def parse_yyyymmdd(c: Column | str) -> Column:
    text = F.trim(_col(c))
    return F.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd"))


def age_years(d: Column | str, as_of) -> Column:
    """Calendar years between `d` and `as_of`, never negative; 0 for a missing date."""
    years = F.year(F.lit(as_of).cast("date")) - F.year(_col(d))
    return F.greatest(F.lit(0), years).cast("long")


def porte_label(c: Column | str) -> Column:
    code = _col(c)
    label = None
    for key, text in PORTE_LABELS.items():
        label = F.when(code == key, text) if label is None else label.when(code == key, text)
    return label.otherwise(empty_to_null(code))


def cnpj_key(basico: Column | str, ordem: Column | str, dv: Column | str) -> Column:
    """Full key; null when a part is null."""
    return F.concat(_col(basico), _col(ordem), _col(dv))


def is_strange_uf(c: Column | str) -> Column:
    """True for a state code that is missing or not two letters."""
    return ~F.coalesce(F.upper(F.trim(_text(c))).rlike(r"\A\p{L}{2}\z"), F.lit(False))
