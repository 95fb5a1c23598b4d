"""Prints the recall of the pipeline's near stage: python tests/llm/measure_recall.py [folder of tables].

Every document whose id is divisible by 20 is held against all rows by exact
Jaccard similarity of 5-word shingles. A pair at 0.8 or more counts as caught if
at most one of its documents stays. The keys are also counted by themselves: how
many of the pairs share a byte triple, how many a smallest hash, and how many
pass the tally of positional bytes. With --made it prints, for made-up pairs of
unequal sets by size and similarity, which share meets by a key and passes the
tally and the radius.
"""

import collections
import os
import sys

import numpy as np
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT

from folioforge.llm import common, nearcopies  # noqa: E402


def similar_pairs(sets: dict, every: int = 20, least: float = 0.8) -> dict:
    """{(query, other): similarity} by an inverted index of shingles that loses nothing."""
    owners = collections.defaultdict(list)
    for i, s in sets.items():
        for h in s:
            owners[h].append(i)
    out = {}
    for i in sets:
        if i % every == 0:
            shared = collections.Counter(j for h in sets[i] for j in owners[h])
            for j, n in shared.items():
                sim = n / (len(sets[i]) + len(sets[j]) - n)
                if j != i and sim >= least:
                    out[i, j] = sim
    return out


def recall(spark, folder: str, every: int = 20) -> dict:
    df = spark.read.parquet(f"{folder}/documents.parquet")
    table, sets, keys = common.WordHashes(), {}, {}
    places = nearcopies.triples()
    for r in df.select("doc_id", "text").collect():
        own = nearcopies.shingle_set(table.of(r.text.encode().lower().split()))
        sets[r.doc_id] = own.tolist()
        fp, mins = nearcopies.wide_fingerprint(own)
        keys[r.doc_id] = np.frombuffer(fp, np.uint8)[places], np.frombuffer(mins, np.uint64), np.frombuffer(fp, np.uint8)
    pairs = similar_pairs(sets, every)
    kept = {r.doc_id for r in nearcopies.representatives(df).collect()}
    share = lambda ok: round(sum(map(ok, pairs)) / max(1, len(pairs)), 4)
    return {
        "pairs": len(pairs), "not equal": sum(s < 1 for s in pairs.values()), "caught": share(lambda p: not (p[0] in kept and p[1] in kept)),
        "by triples": share(lambda p: (keys[p[0]][0] == keys[p[1]][0]).all(axis=1).any()), "by smallest hashes": share(lambda p: (keys[p[0]][1] == keys[p[1]][1]).any()),
        "tally": share(lambda p: (keys[p[0]][2] == keys[p[1]][2]).sum() >= nearcopies.SHARED), "not equal caught": round(sum(not (p[0] in kept and p[1] in kept) for p, s in pairs.items() if s < 1) / max(1, sum(s < 1 for s in pairs.values())), 4),
    }


def made_pairs(sizes=(10, 50, 300), similarities=(0.8, 0.85, 0.9), pairs: int = 400) -> dict:
    """{(size, similarity): (by triples, by smallest hashes, by either)}: shares that meet there, have SHARED bytes and are within the radius."""
    rng, places, out = np.random.default_rng(1), nearcopies.triples(), {}
    for size in sizes:
        for similarity in similarities:
            both, met = round(2 * size * similarity / (1 + similarity)), []
            for _ in range(pairs):
                words = rng.integers(0, 1 << 63, 2 * size - both, dtype=np.uint64)
                fps, mins = zip(*(nearcopies.wide_fingerprint(np.sort(s)) for s in (words[:size], words[size - both :])))
                x, y = (np.frombuffer(f, np.uint8) for f in fps)
                passes = (x == y).sum() >= nearcopies.SHARED and np.bitwise_count(x ^ y).sum() <= nearcopies.RADIUS
                triple = (x[places] == y[places]).all(axis=1).any()
                smallest = (np.frombuffer(mins[0], np.uint64) == np.frombuffer(mins[1], np.uint64)).any()
                met.append([passes and triple, passes and smallest, passes and (triple or smallest)])
            out[size, similarity] = tuple(np.mean(met, axis=0).round(3).tolist())
    return out


if __name__ == "__main__":
    if "--made" in sys.argv:
        for cell, shares in made_pairs().items():
            print(*cell, *shares)
        sys.exit()
    session = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "16").config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    print(recall(session, *sys.argv[1:2] or ["/root/testdata/sf0.1"]))
