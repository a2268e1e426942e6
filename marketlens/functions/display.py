"""Brazilian display formats. A missing or unreadable number shows as `-`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _number(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).try_cast("double")


def fmt_br_number(c: Column | str, decimals: int = 0) -> Column:
    """1234.5 as `1.234,5`."""
    return F.coalesce(F.translate(F.format_number(_number(c), decimals), ",.", ".,"), F.lit("-"))


def fmt_br_money(c: Column | str, compact: bool = False) -> Column:
    """`R$ 1.234,50`, or in thousands, millions and billions when `compact`."""
    value = _number(c)
    full = F.concat(F.lit("R$ "), fmt_br_number(value, 2))
    if not compact:
        return full

    def scaled(unit: float, suffix: str) -> Column:
        return F.concat(F.lit("R$ "), fmt_br_number(value / F.lit(unit), 1), F.lit(suffix))

    size = F.abs(value)
    return (
        F.when(value.isNull(), "-")
        .when(size >= 1e9, scaled(1e9, " bi"))
        .when(size >= 1e6, scaled(1e6, " mi"))
        .when(size >= 1e3, scaled(1e3, " mil"))
        .otherwise(full)
    )


def fmt_br_percent(c: Column | str, decimals: int = 1) -> Column:
    text = fmt_br_number(c, decimals)
    return F.when(text == "-", text).otherwise(F.concat(text, F.lit("%")))


def code_label(code: Column | str, text: Column | str, missing: str = "Sem descricao") -> Column:
    """`code - text`, with a stand-in for a missing text."""
    text = F.col(text) if isinstance(text, str) else text
    code = F.col(code) if isinstance(code, str) else code
    return F.concat(code, F.lit(" - "), F.coalesce(text, F.lit(missing)))


def label_code(label: Column | str) -> Column:
    """The code in front of a `code - text` label."""
    return F.split(F.col(label) if isinstance(label, str) else label, " - ").getItem(0)
