"""Edit distances of word sequences by banded alignment, many pairs at a time."""

import numpy as np

FAR = 1 << 28
CELLS = 1 << 20


def _band(pairs, cap, width):
    """Distances within a band of ``width`` diagonals on each side; FAR where the band or the
    cap is exceeded.  ``pairs`` come in order of their first length."""
    n = np.array([len(a) for a, _ in pairs])
    m = np.array([len(b) for _, b in pairs])
    left = np.full((len(pairs), int(n.max(initial=0))), -1, np.int64)
    right = np.full((len(pairs), max(int(m.max(initial=0)), int(n.max(initial=0))) + 2 * width + 1), -2, np.int64)
    for p, (a, b) in enumerate(pairs):
        left[p, :len(a)] = a
        right[p, width:width + len(b)] = b
    diagonal = np.arange(-width, width + 1, dtype=np.int32)
    row = np.broadcast_to(np.where(diagonal >= 0, diagonal, FAR), (len(pairs), len(diagonal))).astype(np.int32)
    result = np.full(len(pairs), FAR, np.int64)
    inside = np.abs(m - n) <= width
    done = 0
    while done < len(pairs) and n[done] == 0:
        result[done] = m[done] if inside[done] else FAR
        done += 1
    step = 0
    while done < len(pairs):
        step += 1
        active = row[done:]
        best = active + (right[done:, step - 1:step + 2 * width] != left[done:, step - 1:step])
        np.minimum(best[:, :-1], active[:, 1:] + 1, out=best[:, :-1])
        best -= diagonal
        np.minimum.accumulate(best, axis=1, out=best)
        best += diagonal
        row[done:] = np.minimum(best, FAR)
        first = done
        while done < len(pairs) and n[done] == step:
            if inside[done]:
                result[done] = row[done, m[done] - n[done] + width]
            done += 1
        if step % 64 == 0 and first < len(pairs) and (row[done:].min(axis=1, initial=FAR) > cap[done:]).all():
            break
    result[result > np.minimum(width, cap)] = FAR
    return result


def least_distance(a: np.ndarray, b: np.ndarray) -> int:
    """A lower bound of the edit distance: the longer length less the items in common.

    Items are counted in bins by their low bits; two items in one bin only lower the bound.
    """
    most = max(len(a), len(b))
    bins = 1 << max(8, (4 * most).bit_length())
    common = np.minimum(np.bincount(a & (bins - 1), minlength=bins), np.bincount(b & (bins - 1), minlength=bins))
    return most - int(common.sum())


def edit_distances(pairs: list[tuple[np.ndarray, np.ndarray]], caps: list[int]) -> np.ndarray:
    """The edit distance of each pair of integer sequences, or FAR where it exceeds its cap.

    Pairs with too few items in common are told apart without an alignment.  Bands start
    narrow and are widened for the pairs that need it, up to their cap, so close pairs cost
    little.  A distance inside its band is exact.
    """
    result = np.full(len(pairs), FAR, np.int64)
    caps = np.array(caps, np.int64)
    todo = [p for p in range(len(pairs)) if least_distance(*pairs[p]) <= caps[p]]
    width = 16
    while todo:
        todo.sort(key=lambda p: len(pairs[p][0]))
        left, start = [], 0
        while start < len(todo):
            stop = start + 1
            while stop < len(todo) and (stop + 1 - start) * (2 * width + len(pairs[todo[stop]][0])) <= CELLS \
                    and len(pairs[todo[stop]][0]) <= 2 * len(pairs[todo[start]][0]) + 64:
                stop += 1
            part = todo[start:stop]
            found = _band([pairs[p] for p in part], caps[part], width)
            result[part] = found
            left += [p for p, d in zip(part, found.tolist()) if d >= FAR and caps[p] > width]
            start = stop
        todo, width = left, width * 4
    return result
