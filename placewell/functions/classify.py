"""Ordered keyword classes: the first rule with a matching keyword names the class."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Rules = Sequence[tuple[str, Sequence[str]]]

# Class labels and their keywords, in order of precedence. Keywords
# match as substrings in any case, so "Barbers" falls under "Bar".
PLACE_RULES: Rules = (
    ("Food & Restaurants", ("Restaurant", "Food", "Coffee", "Bar", "Pizza")),
    ("Health & Medical", ("Health", "Medical", "Doctor", "Dentist")),
    ("Automotive", ("Automotive", "Gas Station", "Auto")),
    ("Beauty & Personal Care", ("Beauty", "Hair", "Nail", "Spa")),
    ("Retail & Shopping", ("Shopping", "Store")),
    ("Home Services", ("Home Services", "Plumbing", "Contractor")),
    ("Fitness", ("Fitness", "Gym", "Yoga")),
    ("Education", ("Education", "School", "College")),
    ("Financial Services", ("Financial", "Bank", "Insurance")),
    ("Travel & Hospitality", ("Hotel", "Travel", "Tour")),
    ("Entertainment", ("Entertainment", "Museum", "Cinema")),
)
DEFAULT_CLASS = "Other"


def classify(
    df: DataFrame, source: str, target: str,
    rules: Rules = PLACE_RULES, default: str = DEFAULT_CLASS,
) -> DataFrame:
    """Add ``target``: the label of the first rule met by ``source``, else ``default``.

    The text is lower-cased once in a projection of its own; all the keyword tests
    read that column.
    """
    folded = f"_{target}_folded"
    label = None
    for name, keywords in rules:
        hit = reduce(or_, (F.contains(F.col(folded), F.lit(k.lower())) for k in keywords))
        label = F.when(hit, F.lit(name)) if label is None else label.when(hit, F.lit(name))
    label = F.lit(default) if label is None else label.otherwise(F.lit(default))
    return df.withColumn(folded, F.lower(F.col(source))).withColumn(target, label).drop(folded)
