"""Problem 3: an exact round trip through every chain, and planted damage."""

import random

import pytest

from workloom.llm import encodings

CLEAN = ["Sainte-Orvélie", "Île-Brodelle", "L’Anse-aux-Grèbes", "Mont-Çédille", "Port Halder", "Château-Lavoie", "Crêpière de nuit", "Chargé de clientèle", "Ingénieur – poste à mi-temps", "São Velmo", "NATAÇÃO", "Caf&eacute; attendant", "Ready for a change?", "Line “lead” hand"]


def damage(text, chain):
    for read, true in reversed(encodings.CHAINS[chain]):
        data = text.encode(true)
        if read.startswith("utf-16") and len(data) % 2:
            data += b" "
        text = data.decode(read)
    return text


@pytest.mark.parametrize("chain", range(1, len(encodings.CHAINS)))
def test_inverse(chain):
    done = 0
    for text in CLEAN[:9]:
        try:
            garbled = damage(text, chain)
        except UnicodeError:
            continue
        assert encodings.invert(garbled, chain) == text
        done += 1
    assert done


def test_planted_damage(spark):
    rng, rows, truth = random.Random(4), [], {}
    common = [k for k in range(1, len(encodings.CHAINS)) if encodings.chain_name(k) in ("utf-8>cp1252", "utf-8>mac_roman", "utf-8>cp437", "utf-8>utf-16-le", "utf-8>cp1252+utf-8>cp1252", "cp1252>mac_roman")]
    for k in range(6000):
        text = rng.choice(CLEAN)
        given = text
        if k % 20 == 0 and not text.isascii():
            try:
                given = damage(text, rng.choice(common))
            except UnicodeError:
                given = text
        elif k % 97 == 0:
            given = text.encode("ascii", "replace").decode()
        if given != text:
            truth[k] = text
        rows.append((k, "f", rng.choice(["x", "y", None]), given))
    rows += [(9001, "f", "x", None), (9002, "f", "x", ""), (9003, "f", "x", "�" * 3), (9004, "f", "x", "plain " * 5000)]
    df = spark.createDataFrame(rows, "record_id bigint, field string, source string, value string")
    got = {r.record_id: r for r in encodings.repair(df).collect()}
    assert got.pop(9003).status == "lost" and not {9001, 9002, 9004} & set(got)
    hit = len(set(got) & set(truth))
    assert hit >= 0.97 * len(truth) and hit >= 0.97 * len(got)
    assert sum(got[k].restored == truth[k] for k in set(got) & set(truth)) >= 0.9 * hit
    assert encodings.repair(df.limit(0)).isEmpty()
