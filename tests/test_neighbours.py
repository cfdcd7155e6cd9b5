"""Every organisation votes for the others."""

import math
from collections import Counter, defaultdict

import pytest

from cairnfield.plans import curation

NAMES = {f"O{i:02d}": f"{a} {b}" for i, (a, b) in enumerate((a, b) for a in ("North", "Delta", "Oak", "River") for b in ("Dairy", "Steel", "Foods"))} | {"O50": "Unmet"}


def test_every_other_organisation_votes(spark, tmp_path):
    spark.createDataFrame(list(NAMES.items()), "ID string, ORGANIZATION_NAME string").write.parquet(f"{tmp_path}/organization.parquet")
    got = {r.id: (r.label, r.votes) for r in curation.knn_sources(spark, str(tmp_path)).collect()}
    words = {i: n.lower().split() for i, n in NAMES.items()}
    df = Counter(w for ws in words.values() for w in ws)
    idf = {w: math.log((1 + len(words)) / (1 + k)) + 1 for w, k in df.items()}
    unit = {i: {w: idf[w] / math.hypot(*[idf[x] for x in ws]) for w in ws} for i, ws in words.items()}
    expected = {}
    for i, x in unit.items():
        scores = sorted((-round(sum(v * y.get(w, 0) for w, v in x.items()), 12), j) for j, y in unit.items() if j != i and set(x) & set(y))
        votes = defaultdict(float)
        for s, j in scores[:5]:
            votes[NAMES[j].split(" ")[-1]] -= s
        if votes:
            label, v = min(votes.items(), key=lambda t: (-t[1], t[0]))
            expected[i] = (label, pytest.approx(v, abs=2e-6))
    assert got == expected and len(got) == 12
