"""Matching of two arrays with repeats, inside one row and without a shuffle.

Both arrays are tagged with their side and sorted together, so equal keys form a run of
left entries followed by a run of right entries. Cost is n log n in the row's own length;
exploding the entries instead would shuffle many times the volume of the text.

The functions take and return Spark SQL text, for `expr`: the nested lambdas reach the JVM as one
string, where the same tree out of Column calls takes seconds to put together.
"""

from __future__ import annotations

# Above this many common keys sorting costs less than one scan per key (measured).
SCAN_LIMIT = 256


def let(name: str, value: str, body: str) -> str:
    """Evaluate `value` once and use it in `body` under `name`."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def run_starts(entries: str, *fields: str) -> str:
    """Places where a sorted array changes (in the given fields), and its size last."""
    changes = " or ".join(
        f"get({entries}, at){field} <> get({entries}, at - 1){field}"
        for field in ([f".{name}" for name in fields] or [""])
    )
    return (
        f"filter(sequence(0, size({entries})), "
        f"at -> at = 0 or at = size({entries}) or {changes})"
    )


def _shared_runs(entries: str, starts: str) -> str:
    """For every key on both sides: its two run places and the smaller run length."""
    right_at, end = f"get({starts}, nth + 1)", f"get({starts}, nth + 2)"
    left, right = f"get({entries}, left_at)", f"get({entries}, {right_at})"
    return f"""filter(
        transform({starts}, (left_at, nth) -> struct(
            {left}.key as key, left_at as left_at, {right_at} as right_at,
            case when {left}.side = 0 and {right}.side = 1 and {left}.key = {right}.key
                 then least({right_at} - left_at, {end} - {right_at}) end as shared)),
        run -> run.shared is not null)"""


def shared_counts(left: str, right: str) -> str:
    """array<struct<key, shared>>: per common key the smaller of its two counts.

    With few common keys each is counted by a plain scan of both arrays; with many, the arrays are
    sorted together. Both are exact, and neither is quadratic in the length of the row.
    """

    def occurrences(keys: str) -> str:
        return f"size({keys}) - size(array_remove({keys}, key))"

    def tagged(keys: str, side: int) -> str:
        return f"transform({keys}, key -> struct(key as key, {side} as side))"

    scanned = f"""transform(common, key -> struct(
        key as key, least({occurrences(left)}, {occurrences(right)}) as shared))"""
    runs = let("starts", run_starts("merged", "side", "key"), _shared_runs("merged", "starts"))
    by_sort = let(
        "merged",
        f"sort_array(concat({tagged(left, 0)}, {tagged(right, 1)}))",
        f"transform({runs}, run -> struct(run.key as key, run.shared as shared))",
    )
    return let(
        "common",
        f"array_intersect({left}, {right})",
        f"case when size(common) <= {SCAN_LIMIT} then {scanned} else {by_sort} end",
    )


def places(size: str) -> str:
    """0 .. size-1 as an array, empty for size 0."""
    return f"case when {size} > 0 then sequence(0, {size} - 1) else cast(array() as array<int>) end"


def free_places(size: str, links: str, side: str) -> str:
    """Places of one side that no link uses, ascending."""
    return f"array_except({places(size)}, transform({links}, link -> link.{side}))"


def align_last(left: str, right: str, left_at: str | None = None, right_at: str | None = None) -> str:
    """array<struct<l, r>>: the k-th last place of a word on the left paired with the k-th
    last on the right. `left_at` and `right_at` limit the places looked at (default: all)."""

    def entries(words: str, at: str | None, side: int) -> str:
        # Words the other side lacks are left out, unless the test would cost more than it saves.
        useful = f"size(common) > {SCAN_LIMIT} or array_contains(common, get({words}, place))"
        return (
            f"transform(filter({at or places(f'size({words})')}, place -> {useful}), "
            f"place -> struct(get({words}, place) as key, {side} as side, -place as back))"
        )

    merged = f"sort_array(concat({entries(left, left_at, 0)}, {entries(right, right_at, 1)}))"
    runs = let("starts", run_starts("merged", "side", "key"), _shared_runs("merged", "starts"))
    pairs = """transform(sequence(0, run.shared - 1), k -> struct(
        -get(merged, run.left_at + k).back as l, -get(merged, run.right_at + k).back as r))"""
    aligned = let("merged", merged, f"flatten(transform({runs}, run -> {pairs}))")
    return let(
        "common",
        f"array_intersect({left}, {right})",
        "case when size(common) = 0 then cast(array() as array<struct<l: int, r: int>>) "
        f"else {aligned} end",
    )


def chunk_count(pairs: str) -> str:
    """Number of runs in which both places advance by one, walking by the left place."""
    breaks = (
        "at = 0 or link.l <> get(ordered, at - 1).l + 1 or link.r <> get(ordered, at - 1).r + 1"
    )
    return let(
        "ordered", f"sort_array({pairs})", f"size(filter(ordered, (link, at) -> {breaks}))"
    )
