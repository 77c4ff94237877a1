import hashlib
import random

import pytest

from storelake.llm.exact_dedup import exact_duplicates
from storelake.llm.shared import ship_package
from tests.llm.tables import DOCS, clashing, documents


def expected(rows):
    lower = {r: (r[1] or "").encode().lower() for r in set(rows)}
    out = []
    for text in set(lower.values()):
        same = [r for r in rows if lower[r] == text]
        known = [r[0] for r in same if r[0] is not None]
        keep, free = max(known, default=None), True
        for r in same:
            kept = free and r[0] == keep
            free = free and not kept
            out.append((r[0], keep, len(same), kept, hashlib.sha256(text).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("hash_bits", [64, 2])
def test_equals_brute_force_even_where_hashes_clash(spark, hash_bits):
    ship_package(spark)
    pick = random.Random(3)
    alphabet = ["ab", "AB", "ba", "É", "é", " ", "x" * 7]
    rows = [(i, "".join(pick.choice(alphabet) for _ in range(pick.randrange(9)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "ab" * 5000), (203, "AB" * 5000), (204, "ab" * 4999 + "ac"), (None, "ab"), (None, None)]
    rows += [(7, "repeat"), (7, "repeat"), (7, "other text"), (6, "REPEAT")]
    got = exact_duplicates(documents(spark, rows), block_bytes=8, hash_bits=hash_bits)
    assert found(got) == expected(rows)


def test_hot_group_empty_table_and_other_columns(spark):
    ship_package(spark)
    rows = [(i, "copy " * 40) for i in range(400)] + [(1000 + i, f"own {i}") for i in range(200)]
    assert found(exact_duplicates(clashing(documents(spark, rows)), block_bytes=16)) == expected(rows)
    assert exact_duplicates(spark.createDataFrame([], DOCS)).collect() == []
