"""Problem 5: the automaton against plain edit distance, and titles as they are typed."""

import random

import pytest

from workloom.llm import names, titles

LIST = [(1, "Kiln firing labourers"), (2, "Kiln firing engineers"), (3, "Drone survey managers"), (4, "Hospital laundry managers"), (5, "Library cataloguing coordinators"), (6, "Glass tempering specialists"), (7, "Drone repair managers")]


def test_search_like_brute_force():
    trie, rng = titles.Trie([(k, x.lower()) for k, x in LIST]), random.Random(2)
    alphabet = "abdeilnorstuvgkm"
    for _ in range(150):
        path = rng.choice(list(trie.paths))
        key = list(path)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(key) + 1)
            move = rng.randint(0, 3)
            if move == 0:
                key.insert(at, rng.choice(alphabet))
            elif at < len(key):
                if move == 1:
                    del key[at]
                elif move == 2:
                    key[at] = rng.choice(alphabet)
                elif at + 1 < len(key):
                    key[at], key[at + 1] = key[at + 1], key[at]
        key = "".join(key)
        most, want = titles.allowed_edits(len(key)), {}
        for other, hits in trie.paths.items():
            d = names.edits(key, other, most)
            for ident, least in hits:
                if d <= most and d < least:
                    want[ident] = min(d, want.get(ident, 9))
        assert trie.search(key, most) == want, key


def test_a_path_itself_keeps_its_neighbours():
    trie = titles.Trie([(4, "wood machine operators"), (5, "wool machine operators")])
    assert trie.search("woodmachineoperator", 2) == {4: 0, 5: 1} and trie.search("woodmachineoperatot", 2) == {4: 1, 5: 2}


def test_other_alphabets(spark):
    rows = [(1, "Пекарь хлеба"), (2, "Старший пекарь"), (3, "Хлеба пекарь"), (4, "面包师")]
    reference = spark.createDataFrame([(1, "хлеба пекарь"), (2, "面包师")], "id int, noc21_name string")
    got = titles.map_titles(spark.createDataFrame(rows, "job_id bigint, raw_title string"), reference).collect()
    assert {r.job_id: r.entry_id for r in got} == {1: 1, 2: None, 3: 1, 4: 2}


CASES = [
    ("Senior Kiln Firring Labourer II", 1), ("laborer - kiln firing", 1), ("Engr. - KILN FIRING", 2), ("Manager Drone & Survey (m/f/x)", 3), ("URGENT: Hosp. laundry mgr – 12 month contract", 4), ("coordinator / library | Port Halder", 5), ("Co-ordinator, Library Cataloguing", 5),
    ("LeadGlass tempering splst", 6), ("glass tempering dept / specialist, Kettle Narrows ON", 6), ("2x Kiln firing labourers [ID 87842]", 1), ("Specialist (glass tempering) - $47/hr", 6), ("Dorne survey manaegr Req #5", 3),
    ("Manager", None), ("Kiln firing", None), ("Drone manager", None), ("Beard Grooming Engineer", None), ("xxx", None), ("", None), (None, None), ("lead", None), ("Kiln firing labourer " * 3000, None),
]


def test_titles(spark):
    rows = [(k, t, "clash", 5) for k, (t, _) in enumerate(CASES)]
    df = spark.createDataFrame([*rows, rows[0]], "job_id bigint, raw_title string, key string, distance int")
    reference = spark.createDataFrame([*LIST, (8, None), (None, "x"), (9, " ")], "id int, noc21_name string")
    got = titles.map_titles(df, reference).collect()
    assert len(got) == len(CASES) + 1
    assert {r.job_id: r.entry_id for r in got} == {k: want for k, (_, want) in enumerate(CASES)}
    status = {CASES[r.job_id][0]: r.status for r in got}
    assert status["Drone manager"] == "ambiguous" and status["xxx"] == status[None] == "unmatched"
    assert {r.status for r in titles.map_titles(df, reference.limit(0)).collect()} == {"unmatched"}
    assert titles.map_titles(df.limit(0), reference).isEmpty()


def test_a_long_list_goes_by_parts(spark, monkeypatch):
    monkeypatch.setattr(titles, "TRIE_ENTRIES", 3)
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(CASES)], "job_id bigint, raw_title string")
    got = titles.map_titles(df, spark.createDataFrame(LIST, "id int, noc21_name string")).collect()
    assert {r.job_id: r.entry_id for r in got} == {k: want for k, (_, want) in enumerate(CASES)}


@pytest.mark.parametrize("n,most", [(6, 0), (7, 1), (12, 2), (26, 3)])
def test_distance_by_length(n, most):
    assert titles.allowed_edits(n) == most
