"""Suffix arrays by linear grouping, and longest earlier matches from them."""

import numpy as np


def suffix_array(text: np.ndarray) -> list[int]:
    """Suffix array of a sequence of whole numbers whose last one is unique and the least.

    First, suffixes are grouped by their Lyndon prefixes: groups are processed in descending order,
    and a suffix whose group's members are previous-smaller to members of the group in hand moves to
    a new group behind its old one, the farther the more members point at it. Then the groups give
    the order in one sweep: the suffix before each sorted one, and all it reaches over
    previous-smaller pointers, come next in their groups. Nothing is renamed and sorted again.
    """
    n = len(text)
    by_first = np.argsort(text, kind="stable")
    ranked = np.asarray(text)[by_first]
    heads = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    sizes = np.diff(np.r_[heads, n])
    group = np.empty(n, np.int64)
    group[by_first] = np.repeat(np.arange(len(heads)), sizes)

    row: list[int] = by_first.tolist()  # suffixes, group by group
    place = np.empty(n, np.int64)
    place[by_first] = np.arange(n)
    at: list[int] = place.tolist()  # place of a suffix in row
    of: list[int] = group.tolist()  # group of a suffix
    first: list[int] = heads.tolist()  # first place of a group
    size: list[int] = sizes.tolist()
    prev = [-2] * n  # previous smaller suffix; -1 none, -2 not known yet

    def move(s: int, g: int, new: int) -> None:
        """Move suffix ``s`` from the end of group ``g`` to the front of group ``new`` behind it."""
        size[g] -= 1
        end = first[g] + size[g]
        other, here = row[end], at[s]
        row[here], at[other] = other, here
        row[end], at[s] = s, end
        of[s], first[new] = new, end
        size[new] += 1

    def new_group() -> int:
        first.append(0)
        size.append(0)
        return len(first) - 1

    end = n - 1
    while end >= 0:
        g = of[row[end]]
        begin = first[g]
        pointed: dict[int, int] = {}
        for i in row[begin : end + 1]:
            j, waiting = i - 1, []
            while j >= 0:
                here = first[of[j]]
                if here < begin:
                    break
                if prev[j] == -2:  # of the same group, not looked at yet
                    waiting.append(j)
                    j -= 1
                else:
                    j = prev[j]
            prev[i] = j
            for w in waiting:
                prev[w] = j
        for i in row[begin : end + 1]:
            p = prev[i]
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        if len(pointed) == 1:
            ((p, _),) = pointed.items()
            g = of[p]
            if size[g] > 1:
                move(p, g, new_group())
        else:
            by_count: dict[int, list[int]] = {}
            for p, times in pointed.items():
                by_count.setdefault(times, []).append(p)
            for times in sorted(by_count, reverse=True):
                made: dict[int, int] = {}
                for p in by_count[times]:
                    g = of[p]
                    if g not in made:
                        made[g] = new_group()
                    move(p, g, made[g])
        end = begin - 1

    order = [-1] * n
    done = bytearray(n)
    order[0] = n - 1
    done[n - 1] = 1
    for i in range(n):
        j = order[i] - 1
        while j >= 0 and not done[j]:
            g = of[j]
            order[first[g]] = j
            first[g] += 1
            done[j] = 1
            j = prev[j]
    return order


def longest_earlier(text: list[int], order: list[int]) -> list[tuple[int, int]]:
    """For each position the length of the longest match that starts earlier, and one such start.

    The nearest suffixes on both sides in the suffix array that start earlier hold the longest match;
    lengths carry over from one position to the next, so all steps are linear.
    """
    n = len(text)
    above, below = [-1] * n, [-1] * n
    stack: list[int] = []
    for s in order:
        while stack and stack[-1] > s:
            below[stack.pop()] = s
        above[s] = stack[-1] if stack else -1
        stack.append(s)
    out = []
    up = down = 0
    for s in range(n):
        up, down = max(0, up - 1), max(0, down - 1)
        a, b = above[s], below[s]
        if a < 0:
            up = 0
        else:
            while s + up < n and text[a + up] == text[s + up]:
                up += 1
        if b < 0:
            down = 0
        else:
            while s + down < n and text[b + down] == text[s + down]:
                down += 1
        out.append((up, a) if up >= down else (down, b))
    return out
