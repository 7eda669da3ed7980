"""Problem 7: parts against brute force, and planted spellings."""

import random
from itertools import permutations

import pytest

from workloom.llm import names


def plain_edits(a, b):
    table = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            table[i][j] = min(table[i - 1][j] + 1, table[i][j - 1] + 1, table[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                table[i][j] = min(table[i][j], table[i - 2][j - 2] + 1)
    return table[-1][-1]


def test_edits_and_deletions():
    rng = random.Random(1)
    for _ in range(1500):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 7))) for _ in range(2))
        d = plain_edits(a, b)
        assert names.edits(a, b, 2) == min(d, 3)
        if d <= 2:
            assert names.deletions(a, 2) & names.deletions(b, 2)


def test_long_tokens_share_a_part():
    rng = random.Random(3)
    for n in (23, 25, 40, 5000):
        for _ in range(30 if n < 100 else 3):
            a = "".join(rng.choice("abcdefgh") for _ in range(n))
            b = list(a)
            for _ in range(2):
                at, move = rng.randrange(len(b) - 1), rng.randrange(4)
                b[at : at + 2] = {0: [b[at + 1], b[at]], 1: [b[at]], 2: [b[at], "x", b[at + 1]], 3: ["y", b[at + 1]]}[move]
            b = "".join(b)
            assert names.edits(a, b, 2) <= 2 and names.part_keys(a, 2) & names.part_keys(b, 2)
            assert len(names.part_keys(a, 2)) <= 125


def test_assignment():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 5)
        cost = [[rng.choice([0.0, 0.1, 0.2, 1.0, 100.0]) for _ in range(n)] for _ in range(n)]
        best = min(sum(cost[i][p[i]] for i in range(n)) for p in permutations(range(n)))
        got = names.assignment(cost)
        assert sorted(got) == list(range(n)) and sum(cost[i][got[i]] for i in range(n)) == pytest.approx(best)


@pytest.mark.parametrize("a,b,same", [
    ("robert hasagas bakery", "bob bakery hasagas", True), ("r. hasagas bakery", "richard hasagas bakery", True), ("robert hasagas bkry", "robert hasagas bakery", True), ("kavanorl. fostven freight", "kavanorlist fostven freight", True),
    ("kavanoorlist fostven freight", "kavanorlist fosvten freight", True), ("kavanorlist fostven freight", "kavanorlist fostven bakery", False), ("richard x bakery", "robert x bakery", False), ("a", "", False), ("fostven", "fostven fostven", False),
])
def test_alignment(a, b, same):
    assert names.same_name(a.split(), b.split()) == same


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 101), (102, 101), (103, 100), (200, 201), (201, 200)]
    got = {r.node: r.label for r in names.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[k] == 1 for k in range(1, 41)) and all(got[k] == 100 for k in range(100, 104)) and got[200] == got[201] == 200


def planted(n):
    """(rows, entity by id): n organisations under up to four spellings each."""
    rng = random.Random(6)
    syllables = ["bo", "ka", "nu", "ri", "tas", "mel", "gor", "pim", "sud", "vex", "hal", "jon"]
    surnames = ["".join(rng.choice(syllables) for _ in range(3)) for _ in range(12)]
    lines = ["Bakery", "Freight", "Roofing", "Dental Clinic", "Window Cleaning"]
    rows, entity = [], {}
    for e in range(n):
        first, second, line = "".join(rng.choice(syllables) for _ in range(5)).title(), rng.choice(surnames).title(), rng.choice(lines)
        given = rng.choice(["", "Robert ", "Katherine "])
        base = f"{given}{first} {second} {line}"
        short = {"Bakery": "Bkry", "Freight": "Frt", "Roofing": "Rfg", "Dental Clinic": "Dent. Clin.", "Window Cleaning": "Window Clng"}[line]
        swapped = first[:2] + first[3] + first[2] + first[4:]
        forms = [f"{base} Inc.", f"{base} Ltée (Hiring)", f"{given}{swapped} {second} {line} Corp.", f"{line} {given}{first} {second}".upper(), f"{given}{first} {second} {short} #12", base.replace("Robert", "Bob").replace("Katherine", "K.")]
        for form in rng.sample(forms, rng.randint(1, 4)):
            entity[len(rows)] = (first, second, line, given)
            rows.append((len(rows), form))
    return rows, entity


def test_planted_spellings(spark):
    rows, entity = planted(150)
    rng = random.Random(8)
    vast = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5000))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "Inc."), (len(rows) + 3, vast), (len(rows) + 4, vast[:2500] + vast[2501:])]
    df = spark.createDataFrame(rows, "id int, name string")
    linked = names.link_names(df)
    pairs = {(r.a, r.b) for r in names.linked_pairs(linked, "a", "b").collect()}
    assert (len(rows) - 2, len(rows) - 1) in pairs
    pairs.discard((len(rows) - 2, len(rows) - 1))
    want = {(a, b) for a in entity for b in entity if a < b and entity[a] == entity[b]}
    assert len(pairs & want) >= 0.95 * len(want) and len(pairs & want) >= 0.95 * len(pairs)
    assert names.link_names(df.limit(0)).isEmpty()
    narrow = {(r.a, r.b) for r in names.linked_pairs(names.link_names(df, block_names=2), "a", "b").collect()}  # nearly all blocks are hot
    assert len(narrow & want) >= 0.95 * len(want) and len(narrow & want) >= 0.95 * len(narrow)


def test_many_names_of_one_frame(spark):
    """100,000 names of one line of business whose blocks by surname are hot: none of them is compared whole."""
    rng = random.Random(9)
    surnames = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(4)) for _ in range(600)]
    own = lambda k: "".join(("ba", "ko", "ri", "tu", "ne", "zo", "fi", "la", "mu", "se")[int(d)] for d in f"{k:05d}")
    rows = [(k, f"{own(k)}xx {surnames[k % 600]} Bakery Inc.") for k in range(0, 100_000, 2)] + [(k, f"Bakery {surnames[(k - 1) % 600]} {own(k - 1)}xx") for k in range(1, 100_000, 2)]
    linked = names.link_names(spark.createDataFrame(rows, "id int, name string"), block_names=50)
    pairs = names.linked_pairs(linked, "a", "b")
    assert pairs.where("a % 2 = 0 and b = a + 1").count() == 50_000


def test_single_names_are_entities(spark):
    rows = [(3, "Bokanu Roofing Inc."), (4, "Roofing Bokanu Ltd."), (5, "BOKANU ROOFING"), (6, "Vexhal Freight"), (7, None), (8, ""), (None, "Vexhal Freight")]
    linked = names.link_names(spark.createDataFrame(rows, "id int, name string"))
    assert sorted(map(tuple, linked.collect())) == [(3, 3, 2), (4, 3, 2), (5, 3, 2), (6, 6, 0), (7, 7, 0), (8, 8, 0)]
    assert {tuple(r) for r in names.linked_pairs(linked, "a", "b").collect()} == {(3, 4), (3, 5), (4, 5)}
