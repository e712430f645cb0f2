"""Distances between array<double> columns, as built-in higher-order expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _d(c):
    return F.col(c) if isinstance(c, str) else c


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def manhattan(a, b) -> Column:
    return _sum(F.zip_with(_d(a), _d(b), lambda x, y: F.abs(x.cast("double") - y.cast("double"))))


def sq_euclidean(a, b) -> Column:
    return _sum(F.zip_with(_d(a), _d(b), lambda x, y: F.pow(x.cast("double") - y.cast("double"), 2)))


def euclidean(a, b) -> Column:
    return F.sqrt(sq_euclidean(a, b))


def sq_norm(a) -> Column:
    return _sum(F.transform(_d(a), lambda x: F.pow(x.cast("double"), 2)))


def dot(a, b) -> Column:
    return _sum(F.zip_with(_d(a), _d(b), lambda x, y: x.cast("double") * y.cast("double")))


def euclidean_limit(a, b) -> Column:
    """Distance the pair would have with no overlap at all: sqrt(|a|^2 + |b|^2)."""
    return F.sqrt(sq_norm(a) + sq_norm(b))


def cosine_distance(a, b) -> Column:
    """1 - a.b / (|a| |b|); NULL when either vector is zero."""
    return F.lit(1.0) - F.try_divide(dot(a, b), F.sqrt(sq_norm(a)) * F.sqrt(sq_norm(b)))


def hamming(a, b) -> Column:
    return F.size(F.filter(F.zip_with(_d(a), _d(b), lambda x, y: x != y), lambda t: t))


def gower(a, b, ranges) -> Column:
    """1/k sum |a_i - b_i| / range_i; a zero range contributes 0."""
    terms = F.zip_with(
        F.zip_with(_d(a), _d(b), lambda x, y: F.abs(x.cast("double") - y.cast("double"))),
        _d(ranges),
        lambda d, r: F.coalesce(F.try_divide(d, F.nullif(r, F.lit(0.0))), F.lit(0.0)),
    )
    return _sum(terms) / F.size(_d(a))


# Multi-hot (0/1) vectors in long form: only the counts n_a, n_b and overlap n_ab are needed.
def multihot_sq_euclidean(n_a, n_b, n_ab) -> Column:
    return _d(n_a) + _d(n_b) - 2 * _d(n_ab)


def multihot_cosine_distance(n_a, n_b, n_ab) -> Column:
    return F.lit(1.0) - F.try_divide(_d(n_ab).cast("double"), F.sqrt(_d(n_a) * _d(n_b)))
