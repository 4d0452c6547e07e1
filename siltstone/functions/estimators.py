"""Combination of the 12 distinct-count estimates of one window into one number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Positions of the start centroids among the 12 estimates, and the limits.
START_POSITIONS = (7, 6, 10)
MAX_ROUNDS = 5
COMPARED_DECIMALS = 1
FIXED_GROUPS = 3


def middle_of_fixed_groups(estimates: str, size: int = 12) -> Column:
    """Split the estimates into three runs, average each, take the middle average."""
    width = size // FIXED_GROUPS
    means = [
        f"aggregate(slice({estimates}, {1 + g * width}, {width}), 0D, (t, v) -> t + v) / {width}"
        for g in range(FIXED_GROUPS)
    ]
    return F.expr(f"cast(sort_array(array({', '.join(means)}))[1] as bigint)")


def middle_of_kmeans_groups(estimates: str) -> Column:
    """Middle mean of three groups found by one-dimensional k-means.

    A round moves each centroid to the mean of itself and its members. The comparison after a
    round walks the centroids in order, freezes those that kept their value at one decimal and
    stops at the first that moved. Rounds end when none moved.
    """
    groups = range(len(START_POSITIONS))
    fields = [f"'c{g}', cast({estimates}[{p}] as double)" for g, p in enumerate(START_POSITIONS)]
    fields += [f"'f{g}', false" for g in groups] + [f"'m{g}', 0D" for g in groups]
    start = f"named_struct({', '.join(fields)}, 'done', false)"
    rounds = f"(s, i) -> CASE WHEN s.done THEN s ELSE {_kmeans_round('s', estimates)} END"
    middle = "s -> cast(sort_array(array(s.m0, s.m1, s.m2))[1] as bigint)"
    return F.expr(f"aggregate(sequence(1, {MAX_ROUNDS}), {start}, {rounds}, {middle})")


def _kmeans_round(state: str, values: str) -> str:
    groups = range(len(START_POSITIONS))
    fields = {}
    changed = []
    for g in groups:
        nearer = " AND ".join(
            f"abs({state}.c{g} - v) {'<' if other < g else '<='} abs({state}.c{other} - v)"
            for other in groups
            if other != g
        )
        members = f"filter({values}, v -> {nearer})"
        moved = (
            f"CASE WHEN {state}.f{g} THEN {state}.c{g} ELSE "
            f"aggregate({members}, {state}.c{g}, (t, v) -> t + v) / (size({members}) + 1) END"
        )
        fields[f"c{g}"] = moved
        fields[f"m{g}"] = (
            f"aggregate({members}, 0D, (t, v) -> t + v) / greatest(size({members}), 1)"
        )
        changed.append(
            f"(bround({moved}, {COMPARED_DECIMALS}) <> "
            f"bround({state}.c{g}, {COMPARED_DECIMALS}))"
        )
    for g in groups:
        before = " OR ".join(["false", *changed[:g]])
        fields[f"f{g}"] = f"CASE WHEN {before} THEN {state}.f{g} ELSE NOT {changed[g]} END"
    fields["done"] = f"NOT ({' OR '.join(changed)})"
    order = [f"{kind}{g}" for kind in "cfm" for g in groups] + ["done"]
    return "named_struct(" + ", ".join(f"'{name}', {fields[name]}" for name in order) + ")"
