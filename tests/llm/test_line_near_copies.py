import random

from scorewright.llm.editjoin import LineKeys, alike
from scorewright.llm.queries import QUERIES
import numpy as np


def shingles(line):
    w = line.split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_like_lines_share_a_prefix_shingle():
    rng = random.Random(5)
    for _ in range(300):
        a = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(20, 120))]
        b = list(a)
        for _ in range(rng.randrange(1, 6)):
            b[rng.randrange(len(b))] = "other"
        x, y = shingles(" ".join(a)), shingles(" ".join(b))
        near = len(x & y) >= 0.8 * len(x | y)
        line, key = LineKeys([" ".join(a), "\u3000".join(b)]).least_shingles()
        assert not near or set(key[line == 0].tolist()) & set(key[line == 1].tolist())
        assert sorted(np.bincount(line).tolist()) == sorted(len(z) - -(-len(z) * 4 // 5) + 1 for z in (x, y))
        line, key = LineKeys([" ".join(a), " ".join(b)]).shingles()
        assert bool(alike([key[line == 0], key[line == 1]], np.ones(2, bool), np.ones(2, bool))) == near


def test_long_near_copies_and_short_repeats_go(spark, as_table, folder):
    line = [f"word{i}" for i in range(80)]
    copies = [" ".join([*line[:k], "replacement", *line[k + 1:]]) for k in (10, 40, 70)]
    other = " ".join(line[:40] + [f"new{i}" for i in range(40)])
    docs = [(0, " ".join(line) + "\nLes."), (1, copies[0] + "\nLes.\nAnd ornd."), (2, f"{copies[1]}\nAnd ornd.\n\n{other}"), (3, copies[2])]
    as_table(spark.createDataFrame(docs, "doc_id long, text string"))
    got = {r.doc_id: r.text for r in QUERIES["op5_line_dedup"](spark, folder).collect()}
    assert got == {0: docs[0][1], 1: "And ornd.", 2: f"\n{other}", 3: ""}
