"""Column-expression helpers; all are native Spark expressions (no Python UDFs)."""

from annuity.functions.fixedwidth import (
    BLANK,
    Field,
    Layout,
    Slot,
    blank,
    ddmmyy,
    fixed_width,
    layout_width,
    money_parts,
    pad_left,
    signed_int,
    wrong_width,
)

__all__ = [
    "BLANK",
    "Field",
    "Layout",
    "Slot",
    "blank",
    "ddmmyy",
    "fixed_width",
    "layout_width",
    "money_parts",
    "pad_left",
    "signed_int",
    "wrong_width",
]
