"""Slots are consistent over maximal runs of a diagonal."""

import itertools
import random

from eventweave.llm import decontaminate

STORY = ("The farmer near the quiet river sold {a} barrels of cider to Anna before lunch and the miller then carried {b} "
         "sacks up the old wooden stairs while {n} counted every single one of them twice before supper")


def test_best_run_equals_brute_force():
    pick = random.Random(3)
    for _ in range(300):
        windows = [(k, 8, [(f"i{pick.randint(0, 2)}", f"d{pick.randint(0, 2)}") for _ in range(pick.randint(0, 2))] or None)
                   for k in range(pick.randint(0, 12)) if pick.random() < 0.9]
        usable = []
        for place, width, pairs in windows:
            own = {}
            if not any(own.setdefault(i, d) != d for i, d in pairs or ()):
                usable.append((place, width, own))
        want = 0
        for a, b in itertools.combinations(range(len(usable) + 1), 2):
            held, fine = {}, True
            for _, _, own in usable[a:b]:
                fine &= not any(held.setdefault(i, d) != d for i, d in own.items())
            if fine:
                want = max(want, len({t for p, w, _ in usable[a:b] for t in range(p, p + w)}))
        assert decontaminate.best_run(windows)[2] == want


def test_one_name_for_two_is_no_match(spark):
    item = "Anna walked to the market and bought fresh bread for the long table and later Anna walked home with the heavy basket again"
    text = "So Bob walked to the market and bought fresh bread for the long table and later Carol walked home with the heavy basket again"
    bench = spark.createDataFrame([(1, "Then " + item)], "item_id long, text string")
    one = spark.createDataFrame([(1, text.replace("Carol", "Bob")), (2, text)], "doc_id long, text string")
    got = {r.doc_id: r.n_covered for r in decontaminate.leaks(one, bench).collect()}
    assert got[1] > got.get(2, 0)


def test_replaced_slots_and_equal_values(spark):
    bench = spark.createDataFrame([(1, STORY.format(a=12, b=30, n="Peter"))], "item_id long, text string")
    rows = [(1, STORY.format(a=12, b=30, n="Peter")), (2, STORY.format(a=99, b=45, n="Maria")),
            (3, STORY.format(a=7, b=7, n="Peter")), (4, "Nothing of the kind stands here, but many other words do so.")]
    got = {r.doc_id: (r.n_covered, r.n_tokens) for r in decontaminate.leaks(
        spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert set(got) == {1, 2, 3} and all(n == m for n, m in got.values())
