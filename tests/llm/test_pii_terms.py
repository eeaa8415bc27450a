"""Terms that disclose a value count and are marked over whole documents."""

import random

from pagelake.llm import pii
from tests.llm.test_operators import frame, prose


def test_terms_far_from_the_value_and_without_it(spark):
    rng = random.Random(12)
    far = prose(rng, 60)
    rows = [(i, prose(random.Random(100 + i), 30)) for i in range(300)]
    rows += [(1000 + i, f"Quentzal Yü {far} {prose(random.Random(i), 30)} write to q.z@mail.org") for i in range(20)]
    rows += [(2000, f"{prose(rng, 10)} QUENTZAL and quentzals, {prose(rng, 10)} Quentzal"), (2001, "no such name")]
    got = {r.doc_id: r for r in pii.sanitise(frame(spark, rows)).collect()}
    for i, t in rows:
        whole = [x for x in got[i].spans if x.kind in (pii.REMOVE, pii.GENERALISE)]
        assert all(t[x.s : x.e].lower() == x.v for x in whole) and [tuple(x) for x in got[i].base if x.kind == "email"] == [tuple(x) for x in got[i].spans if x.kind == "email"]
    for i in range(1000, 1020):
        assert {"quentzal", "yü"} <= {x.v for x in got[i].spans if x.kind == pii.REMOVE} and "Quentzal" not in got[i].sanitised
    t = dict(rows)[2000]
    marked = [t[x.s : x.e] for x in got[2000].spans]
    assert [m for m in marked if m.lower() == "quentzal"] == ["QUENTZAL", "Quentzal"] and got[2000].base == []
    assert "quentzals" in got[2000].sanitised and got[2001].spans == []


def test_copies_and_repeated_rows_change_nothing(spark):
    rows = [(i, prose(random.Random(100 + i), 30)) for i in range(200)]
    rows += [(1000 + i, f"Xo Quentzal {prose(random.Random(i), 30)} write to q.z@mail.org or 10.2.3.4") for i in range(3)]
    rows += [(1500, f"Omar Belvunto {prose(random.Random(5), 30)} call 10.9.9.9")]
    plain = {r.doc_id: [tuple(x) for x in r.spans] for r in pii.sanitise(frame(spark, rows)).collect()}
    assert {"xo", "quentzal"} <= {x[3] for x in plain[1000]} and {x[4] for x in plain[1500]} == {"ip"}
    more = rows + [(0, rows[0][1])] * 20 + [(3000 + i, rows[-1][1]) for i in range(30)] + [(4000 + i, rows[0][1]) for i in range(500)]
    got = pii.sanitise(frame(spark, more)).collect()
    assert len(got) == len(more) and all([tuple(x) for x in r.spans] == plain[r.doc_id] for r in got if r.doc_id in plain)


def test_many_values_in_one_text(spark):
    text = " ".join(f"10.0.{i % 250}.{i // 250} é" for i in range(3000))
    row = pii.sanitise(frame(spark, [(1, text)])).first()
    assert len(row.base) == 3000 and all(text[x.s : x.e] == x.v for x in row.base) and row.sanitised == " ".join(["[IP] é"] * 3000)
