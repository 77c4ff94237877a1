import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from storelake.llm.shared import ship_package
from storelake.llm.source_divergence import Forest, price, source_divergence
from tests.llm.tables import DOCS, clashing, documents


def terms_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower)


def plain(rows, min_docs, top):
    """Every pair of groups over every kept term, one by one."""
    rows = [(r[1] or "", (r[2] if len(r) > 2 else "") or "", (r[3] if len(r) > 3 else "") or "") for r in rows]
    seen, counts, groups = Counter(), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        groups[lang].add(source)
        seen.update((lang, t) for t in set(terms_of(text)))
        counts[lang, source].update(terms_of(text))
    out = []
    for lang, sources in groups.items():
        kept = [t for (own, t), n in seen.items() if own == lang and n >= min_docs]
        whole = sum((counts[lang, s] for s in sources), Counter())

        def share(held):
            total = sum(held[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (held[t] + 5) // total for t in kept}

        q = share(whole)
        for s in sources:
            p = share(counts[lang, s])
            pairs = [(sum(abs(p[t] - o[t]) for t in kept), other) for other in sources if other != s for o in [share(counts[lang, other])]]
            own = [(p[t] - q[t], t) for t in kept if counts[lang, s][t] and p[t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", own, top)):
                ordered = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(ordered, 1)]
    return sorted(out)


def awkward():
    pick = random.Random(4)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)] + ["Éa", "éa", "日本", "Ab", "aB"]
    rows = [(i, " ".join(pick.choice(words[:10 + 5 * (i % 17)]) for _ in range(pick.randrange(30))) + pick.choice(["", " x1y-z'Q ", "\x00\t"]),
             ["aa", "bb", None, ""][i % 4 if i % 9 else 0], f"s{pick.randrange(7)}" if i % 11 else None) for i in range(400)]
    rows += [(1, None, "aa", "lonely"), (1, None, "aa", "lonely"), (2, "few words here", "rare", "p"), (3, "", "rare", "q"),
             (4, "123 456", "one", "only"), (5, "wa wb " * 30_000, "bb", "long")]
    return rows + rows[:40]


@pytest.mark.parametrize("block, tile", [(4096, 32), (8, 2), (7, 3)])
def test_equals_brute_force(spark, block, tile):
    ship_package(spark)
    rows = awkward()
    found = source_divergence(clashing(documents(spark, rows)), min_docs=5, top_terms=4, block=block, tile=tile)
    assert sorted(map(tuple, found.collect())) == plain(rows, 5, 4)


def test_hot_group_and_empty_table(spark):
    ship_package(spark)
    rows = [(i, "same words for all", "aa", "hot") for i in range(300)] + [(i, f"own words {i}", "aa", f"s{i % 40}") for i in range(80)]
    assert sorted(map(tuple, source_divergence(documents(spark, rows), 30).collect())) == plain(rows, 30, 50)
    assert source_divergence(spark.createDataFrame([], DOCS)).collect() == []


def test_equal_subtrees_are_one_node():
    forest = Forest(np.array([[1, 2, 1, 2, 0, 0, 0, 0], [0, 0, 0, 0, 1, 2, 1, 2]]))
    assert [len(low) for low, _ in forest.halves] == [2, 2, 2]
    totals = np.array([9, 11])
    want = sum(abs(int(price(np.int64(a), 9)) - int(price(np.int64(b), 11))) for a, b in zip([1, 2, 1, 2, 0, 0, 0, 0], [0, 0, 0, 0, 1, 2, 1, 2]))
    assert forest.compared(0, np.array([1]), totals).tolist() == [want]
    assert Forest(np.zeros((2, 0), np.int64)).compared(0, np.array([1]), np.zeros(2, np.int64)).tolist() == [0]


def test_prices_are_exact_for_large_counts():
    for count, total in ((0, 5), (7, 12), (5 * 10**14, 7 * 10**15), (9 * 10**15 - 5, 9 * 10**15)):
        assert int(price(np.array([count]), np.array([total]))[0]) == 1 + 10**9 * (count + 5) // total
