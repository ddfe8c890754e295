"""Row-wise bootstrap: every row is drawn by its own hash in every replicate."""

import hashlib
import math
from collections import Counter

import pytest

from riskframe.catalog.significance import ORACLE
from riskframe.functions.hashing import md5_heads
from riskframe.operators import significance as sg


def plain_draw(key, replicate):
    u = int(hashlib.md5(f"boot:{'' if key is None else key}/{replicate}".encode()).hexdigest()[:8], 16) / 2 ** 32
    return next((k for k in range(13) if u < sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))), 13)


def test_md5_heads_are_those_of_hashlib():
    prefixes = [b"boot:%d/" % i for i in (1, 22, 98765432109)] * 9 + [b"", b"k" * 54, b"k" * 55, b"k" * 200]
    suffixes = [b"%d" % i for i in (1, 10, 1000)]
    assert md5_heads(prefixes, suffixes).tolist() == [
        [int(hashlib.md5(p + s).hexdigest()[:8], 16) for s in suffixes] for p in prefixes]


def test_every_row_is_drawn_by_itself(spark):
    """Weights are those of the rows, not of the counted combinations; one score that many rows share lies in many ranges."""
    rows = [(i, int(i % 3 == 0), 0.5 if i % 2 else (i * 7 % 40) / 40, int(i * 7 % 10 >= 5)) for i in range(400)]
    rows += [(7, 1, 0.5, 0), (7, 1, 0.5, 0), (None, 0, 0.25, 1), (900, 1, None, 1)]
    df = spark.createDataFrame(rows, "id long, y int, score double, pred int").repartition(5)
    got = {r["replicate"]: r for r in sg.bootstrap_replicates(df, "y", "pred", 5, metrics=["accuracy"], score="score", key="id").collect()}
    for rep in range(1, 6):
        cells, scores = Counter(), Counter()
        for key, y, score, pred in rows:
            cells[y, pred] += plain_draw(key, rep)
            if score is not None:
                scores[y, score] += plain_draw(key, rep)
        assert got[rep]["n"] == sum(cells.values())
        assert got[rep]["accuracy"] == pytest.approx(sum(w for (y, p), w in cells.items() if y == p) / sum(cells.values()))
        wins = sum(a * b * ((s > t) + 0.5 * (s == t)) for (y, s), a in scores.items() if y for (x, t), b in scores.items() if not x)
        whole = [sum(w for (y, _), w in scores.items() if y == side) for side in (1, 0)]
        assert got[rep]["roc_auc"] == pytest.approx(wins / whole[0] / whole[1])


def test_reference_draws_rows():
    for name in ("sig_bootstrap", "sig_bootstrap_auc"):
        assert "md5(concat('boot:',id,'/',i))" in ORACLE[name] and "from scored, range(1,1001) r(i)" in ORACLE[name]
