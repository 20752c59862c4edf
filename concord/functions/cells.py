"""Column expressions: normalising, comparing and classifying cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What stands for an empty cell, separators of multi-valued cells, categories from the most severe on.
SENTINELS = ("", "-", ".")
SEPARATORS = ("&", ",")
CATEGORIES = ("truth_only", "value_diff", "candidate_only", "order_diff", "numeric_tol", "flag_expected")
#: Prefixes of feature names and their kinds; the first that fits decides.
KINDS = (("ENS", "ENSEMBL"), ("XM_", "REFSEQ"), ("NM_", "REFSEQ"), ("XR_", "REFSEQ"), ("NR_", "REFSEQ"), ("NP_", "REFSEQ"))
NUMBER = r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def norm_contig(c: Column) -> Column:
    return F.regexp_replace(c, "^chr", "")


def alt_key(alt: Column, sep: str = ",") -> Column:
    """Alternatives regardless of their order, as a text."""
    return F.array_join(F.array_sort(F.split(alt, sep)), sep)


def norm_empty(v: Column, sentinels=SENTINELS) -> Column:
    return F.when(v.isin(*sentinels), "").otherwise(v)


def numeric_or_null(v: Column) -> Column:
    """A double if the text is a plain decimal number, else null: no blanks, no NaN, no suffixes."""
    return F.when(v.rlike(NUMBER), v.try_cast("double"))


def is_close(a: Column, b: Column, rel: float = 1e-3, abs_: float = 0.0) -> Column:
    inf = float("inf")
    finite = (F.abs(a) < inf) & (F.abs(b) < inf)
    return (a == b) | (finite & (F.abs(a - b) <= F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_))))


def order_only(a: Column, b: Column, seps=SEPARATORS) -> Column:
    """Same parts, another order, for one of the separators."""
    out = F.lit(False)
    for sep in seps:
        x, y = F.split(a, sep), F.split(b, sep)
        out = out | ((F.size(x) > 1) & (F.array_sort(x) == F.array_sort(y)) & (x != y))
    return out


def classify_expr(field: Column, flags: Column, left: Column, right: Column, needs: dict[str, str], rel: float = 1e-3, abs_: float = 0.0, sentinels=SENTINELS) -> Column:
    """Category of a cell (candidate left, truth right), null for a match. flags: array of the run's flags; needs: the
    flag without which a field is expected to be filled on the candidate side only."""
    a, b = norm_empty(left, sentinels), norm_empty(right, sentinels)
    x, y = numeric_or_null(a), numeric_or_null(b)
    lacking = F.lit(False)
    for name, flag in needs.items():
        lacking = lacking | ((field == name) & ~F.array_contains(flags, flag))
    return (
        F.when(a == b, None)
        .when(lacking & (a != "") & (b == ""), "flag_expected")
        .when(a == "", "truth_only")
        .when(b == "", "candidate_only")
        .when(x.isNotNull() & y.isNotNull(), F.when(is_close(x, y, rel, abs_), "numeric_tol").otherwise("value_diff"))
        .when(order_only(a, b), "order_diff")
        .otherwise("value_diff")
    )


def pct(match: Column, total: Column) -> Column:
    """Per cent to three places, halves to even; null over nothing. Publish it with its integer counts."""
    return F.bround(F.try_divide(F.lit(100.0) * match, total), 3)


def rate(part: Column, whole: Column) -> Column:
    return F.bround(F.try_divide(part.cast("double"), whole), 4)


def kind_of(feature: Column, kinds=KINDS) -> Column:
    out = F.when(feature == "", "NONE")
    for prefix, kind in kinds:
        out = out.when(feature.startswith(prefix), kind)
    return out.otherwise("OTHER")


def map_text(m: Column) -> Column:
    """A map as text: key=value by comma, in order of keys."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")


def natural_order(c: Column) -> list[Column]:
    digits = c.rlike("^[0-9]+$")
    return [F.when(digits, 0).otherwise(1), F.when(digits, c.try_cast("long")), c]


def locus(contig: Column, pos: Column, ref: Column, alt: Column, allele: Column, feature: Column) -> Column:
    return F.format_string("%s:%d %s>%s %s|%s", contig, pos, ref, alt, allele, feature)
