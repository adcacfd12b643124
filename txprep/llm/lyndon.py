"""Phase one of the linear grouping suffix sorter, and the Lyndon array it yields.

Suffixes start in groups by their first symbol. Groups are processed in
descending order; each suffix of a group points at the nearest one before it in
a smaller group, and the suffixes pointed at move up to new groups, because the
group's common prefix (its context) follows theirs. At the end the context of a
suffix is its longest Lyndon prefix.
"""

from __future__ import annotations


def phase_one(text) -> tuple[list[int], list[int], list[int]]:
    """For ``text`` (small non-negative ints) each suffix's group (its first
    place in group order), previous-smaller pointer (-1: none) and Lyndon
    length. The end of the text is smaller than any symbol."""
    n = len(text)
    counts = [0] * (max(text, default=0) + 1)
    for c in text:
        counts[c] += 1
    first, total = [], 0
    for c in counts:
        first.append(total)
        total += c
    # a group is a range of order[]; its first place is its rank
    size = [0] * n
    for c, f in zip(counts, first):
        if c:
            size[f] = c
    start = [first[c] for c in text]
    fill, order, place = list(first), [0] * n, [0] * n
    for i, c in enumerate(text):
        order[fill[c]] = i
        place[i] = fill[c]
        fill[c] += 1
    before, length = [-1] * n, [1] * n
    top = n
    while top > 0:
        low = start[order[top - 1]]
        members = order[low:top]
        top = low
        if len(members) > 1:
            members.sort()
        context = length[members[0]]
        points: dict[int, int] = {}
        for s in members:
            p = s - 1
            while p >= 0 and start[p] >= low:
                p = before[p]
            before[s] = p
            if p >= 0:
                points[p] = points.get(p, 0) + 1
        if not points:
            continue
        if len(points) == 1:
            levels = [list(points)]
        else:
            by_count: dict[int, list[int]] = {}
            for p, c in points.items():
                by_count.setdefault(c, []).append(p)
            levels = [by_count[c] for c in sorted(by_count, reverse=True)]
        for p, c in points.items():
            length[p] += c * context
        for level in levels:
            moved: dict[int, int] = {}
            for p in level:
                g = start[p]
                m = moved.get(g, 0) + 1
                moved[g] = m
                end = g + size[g] - m              # the last place not yet taken
                at = place[p]
                other = order[end]
                order[end], order[at] = p, other
                place[p], place[other] = end, at
            for p in level:
                g = start[p]
                if moved.get(g, 0) and moved[g] < size[g]:
                    start[p] = g + size[g] - moved[g]
            for g, m in moved.items():
                if m < size[g]:
                    size[g] -= m
                    size[g + size[g]] = m
    return start, before, length


def lyndon_arrays(text: list[int]) -> tuple[list[int], list[int]]:
    """Lengths of the longest Lyndon word from each place on, in the order of
    the symbols and in the reverse order."""
    most = max(text, default=0)
    return phase_one(text)[2], phase_one([most - c for c in text])[2]
