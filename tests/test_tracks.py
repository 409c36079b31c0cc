"""Tracks over key frames against a plain walk of the rule, one object for each track, and assignment against all permutations."""

import itertools
import random

import numpy as np
import pytest

from framelake.operators import clips as C
from framelake.operators.scores import sparse_pairs


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(0, w) * max(0, h)
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return both / union if union > 0 else 0.0


def best_pairs(gain):
    """{row: column} of the greatest total over all one-to-one choices of positive gains."""
    best = (0.0, {})
    rows = sorted({i for i, _ in gain})
    columns = sorted({j for _, j in gain})
    for choice in itertools.product([None, *columns], repeat=len(rows)):
        used = [c for c in choice if c is not None]
        pairs = {i: j for i, j in zip(rows, choice, strict=True) if j is not None}
        if len(set(used)) == len(used) and all(p in gain for p in pairs.items()):
            total = sum(gain[p] for p in pairs.items())
            if total > best[0] + 1e-15:
                best = total, pairs
    return best


def plain(frames, every, new_iou, empty_frames, unmatched_keys, duplicate_iou, max_objects):
    """frames: {number: boxes, best first}; (frame, place in it, track) of what tracks take."""
    live, made, out, start = [], 0, [], min(frames)
    for number in sorted(frames):
        boxes = frames[number]
        if (number - start) % every:
            for t in live:
                t["unseen"] = 0 if any(iou(b, t["box"]) >= new_iou for b in boxes) else t["unseen"] + 1
            live = [t for t in live if t["unseen"] < empty_frames]
            continue
        kept = []
        for t in live:
            if all(iou(t["box"], o["box"]) <= duplicate_iou for o in kept):
                kept.append(t)
        gain = {(i, j): g - new_iou + 1e-12 for i, b in enumerate(boxes) for j, t in enumerate(kept) if (g := iou(b, t["box"])) >= new_iou}
        _, pairs = best_pairs(gain)
        for t in kept:
            t["missed"] += 1
        for i, j in pairs.items():
            kept[j].update(box=boxes[i], missed=0, unseen=0)
            out.append((number, i, kept[j]["name"]))
        live = [t for t in kept if t["missed"] < unmatched_keys]
        for i, b in enumerate(boxes):
            if i not in pairs and (max_objects is None or len(live) < max_objects):
                made += 1
                live.append({"name": made, "box": b, "missed": 0, "unseen": 0})
                out.append((number, i, made))
    return sorted(out)


def random_clip(rng):
    things = [[rng.uniform(0, 40), rng.uniform(0, 40), rng.uniform(-2, 2), rng.uniform(-2, 2)] for _ in range(rng.randrange(1, 5))]
    frames = {}
    for number in range(rng.randrange(1, 9), 60):
        boxes = []
        for t in things:
            t[0], t[1] = t[0] + t[2], t[1] + t[3]
            if rng.random() < 0.75:
                boxes.append((t[0], t[1], t[0] + 12 + rng.random(), t[1] + 10 + rng.random()))
        if boxes:
            frames[number] = boxes
    return frames


@pytest.mark.parametrize("how", [{}, {"max_objects": 2}, {"empty_frames": 2, "unmatched_keys": 1}, {"duplicate_iou": 0.3, "new_iou": 0.1}])
def test_clips_equal_the_plain_walk(how):
    rng = random.Random(str(how))
    every = {"every": 3, "new_iou": 0.3, "empty_frames": 4, "unmatched_keys": 2, "duplicate_iou": 0.8, "max_objects": None} | how
    tracks = 0
    for _ in range(60):
        frames = random_clip(rng)
        rows = [(number, i, b) for number in sorted(frames) for i, b in enumerate(frames[number])]
        got = C.walk_clip(np.array([r[0] for r in rows]), np.array([r[2] for r in rows]), **every)
        want = plain(frames, **every)
        assert sorted((*rows[row][:2], t) for row, t in got) == want
        tracks += len({t for *_, t in want})
    assert tracks > 150


def test_no_rows():
    assert C.walk_clip(np.zeros(0, int), np.zeros((0, 4))) == []


def test_sparse_assignment_has_the_greatest_total():
    rng = random.Random(1)
    for _ in range(150):
        gain = {(rng.randrange(5), rng.randrange(5)): rng.choice([0.25, 0.5, rng.random() + 0.01]) for _ in range(rng.randrange(1, 10))}
        pairs = list(gain)
        taken = sparse_pairs(*np.array(pairs).T, np.array([gain[p] for p in pairs]))
        picked = [p for p, t in zip(pairs, taken, strict=True) if t]
        assert len({i for i, _ in picked}) == len({j for _, j in picked}) == len(picked)
        assert sum(gain[p] for p in picked) == pytest.approx(best_pairs(gain)[0])
    many = np.arange(100_000)  # groups of two rows and two columns
    taken = sparse_pairs(np.repeat(many, 2), np.stack([many, many ^ 1], 1).ravel(), np.tile([2.0, 1.0], len(many)))
    assert taken.reshape(-1, 2)[:, 0].all() and not taken.reshape(-1, 2)[:, 1].any()
