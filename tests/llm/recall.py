"""Recall of the graph search against brute force, at the size of a real shard: python tests/llm/recall.py

Prints for each kind of vectors the share of the 5 nearest (the query itself left out) that the search finds.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from rotativa.llm.hnsw import SHARD_VALUES, build_graph, search_graph  # noqa: E402

SIZE, QUERIES, K = 64, 512, 5


def clustered(random, count, clusters, spread):
    centres = random.standard_normal((clusters, SIZE))
    return centres[random.integers(0, clusters, count)] + spread * random.standard_normal((count, SIZE))


def recall(points: np.ndarray) -> float:
    points = points / np.linalg.norm(points, axis=1, keepdims=True)
    asked = np.arange(0, len(points), len(points) // QUERIES)[:QUERIES]
    found = search_graph(points, build_graph(points), points[asked], K + 1)
    score = points[asked] @ points.T
    score[np.arange(len(asked)), asked] = -2
    best = np.argsort(-score, axis=1)[:, :K]
    kept = [[i for i in row if i != number][:K] for row, number in zip(found.tolist(), asked.tolist())]
    return sum(len(set(a) & set(b)) for a, b in zip(kept, best.tolist())) / best.size


if __name__ == "__main__":
    random, count = np.random.default_rng(5), SHARD_VALUES // SIZE
    kinds = {
        "without structure": random.standard_normal((count, SIZE)),
        "2000 clusters": clustered(random, count, 2000, 0.5),
        "100 tight clusters": clustered(random, count, 100, 0.1),
        "1000 tight clusters": clustered(random, count, 1000, 0.1),
    }
    for kind, points in kinds.items():
        began = time.time()
        print(f"{kind}: {count} vectors, recall {recall(points):.4f}, {time.time() - began:.0f} s", flush=True)
