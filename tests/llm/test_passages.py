import brute
import numpy as np
import pytest
from hushline.llm import substring


def rows(prose):
    shared, loop = prose(50, 60), " ".join(["x y z"] * 40)
    out = [(i, prose(i, 20 * i)) for i in range(12)]
    out += [(100 + i, f"{prose(200 + i, i % 40)}\n{shared}  {prose(300 + i, 10)}") for i in range(60)]
    out += [(200, loop), (201, prose(61, 34)), (202, prose(61, 34)), (203, prose(62, 35)), (204, prose(62, 35))]
    out += [(205, None), (206, ""), (207, prose(3, 60)), (208, "Eins " + prose(63, 40)), (209, "eins " + prose(63, 40))]
    out += [(None, prose(64, 80)), (7, prose(7, 140))]
    return out


@pytest.mark.parametrize("window", [35, 10, 2])
def test_equals_counting_all_windows(spark, prose, window):
    docs = rows(prose)
    got = substring.removal_digests(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), window=window)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute.removals(docs, window), key=str)


def test_least_is_the_first_of_equals():
    values = np.array([3, 1, 1, 2, 0, 5, 0, 0, 9], np.uint64)
    for span in range(1, 9):
        want = [i + int(np.argmin(values[i:i + span])) for i in range(len(values) - span + 1)]
        assert substring._least(values, span).tolist() == want


def test_levels_at_most_double():
    for window in range(1, 120):
        lengths = substring.levels(window)
        assert lengths[-1] == window and all(a < b <= 2 * a for a, b in zip(lengths, lengths[1:]))


def test_texts_are_cut_and_columns_stay(spark, prose):
    shared, a, b, c = prose(1, 55), prose(2, 8), prose(3, 8), prose(4, 8)
    docs = spark.createDataFrame(
        [(1, f" {a}\n\n{shared}\n{b} ", "p"), (2, f"{shared} {c}", None), (3, shared, "q"), (4, None, "r"), (5, "", None), (6, "keep\tthis  ", "s")],
        "doc_id long, text string, rest string",
    )
    got = substring.without_repeats(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [
        (1, f"{a}\n{b}", "p"), (2, c, None), (3, "", "q"), (4, None, "r"), (5, "", None), (6, "keep\tthis  ", "s"),
    ]
    assert substring.without_repeats(docs.limit(0)).collect() == []
    assert substring.removal_digests(docs.limit(0)).collect() == []
