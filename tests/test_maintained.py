import random
from collections import Counter

import pytest

from fragmill.operators.maintained import FRAGMENT, INGREDIENT, changed, deleted, empty, inserted, replaced

F_DDL = "source string, molecule_id string, fragment_hash string, canonical_smiles string, atom_count int, bond_count int"
I_DDL = "molecule_id string, ingredient_name string"


def brute(fragments, ingredients):
    names, out = {}, Counter()
    for m, name in ingredients:
        names.setdefault(m, []).append(name)
    for f in fragments:
        for name in names.get(f[1], [None]):
            out[(f[0], f[1], f[2], name, *f[3:])] += 1
    return dict(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_changes_equals_a_full_computation(spark, tmp_path, seed):
    rng = random.Random(seed)
    frag = lambda: (lambda h: (rng.choice(["small", "big"]), str(rng.randrange(4)), f"h{h}", f"s{h}", h, h - 1))(rng.randrange(3))
    name = lambda: (str(rng.randrange(5)), rng.choice("XY"))
    now_f, now_i = [], []
    make = lambda rows, ddl: spark.createDataFrame(rows, ddl).coalesce(1)
    state = empty(make([], F_DDL), make([], I_DDL))
    for step in range(3):
        gone_f, gone_i = rng.sample(now_f, len(now_f) // 3), rng.sample(now_i, len(now_i) // 2)
        new_f, new_i = [frag() for _ in range(9)], [name() for _ in range(3)]
        state = changed(state, replaced(make(gone_f, F_DDL), make(new_f, F_DDL)), inserted(make(new_i, I_DDL)).unionByName(deleted(make(gone_i, I_DDL))))
        now_f, now_i = list((Counter(now_f) - Counter(gone_f) + Counter(new_f)).elements()), list((Counter(now_i) - Counter(gone_i) + Counter(new_i)).elements())
        written = []
        for n, df in enumerate(state):
            df.write.parquet(str(tmp_path / f"{step}-{n}"))
            written.append(spark.read.parquet(str(tmp_path / f"{step}-{n}")))
        state = type(state)(*written)
        found = {(r.source, r.molecule_id, r.fragment_hash, r.ingredient_name, r.canonical_smiles, r.atom_count, r.bond_count): r.occurrence_count for r in state.view.collect()}
        assert found == brute(now_f, now_i)


def test_deleting_what_is_not_there_is_an_error(spark):
    none = empty(spark.createDataFrame([], F_DDL), spark.createDataFrame([], I_DDL))
    gone = deleted(spark.createDataFrame([("small", "1", "h", "s", 1, 0)], F_DDL))
    with pytest.raises(Exception, match="more often"):
        changed(none, gone).view.collect()
    assert FRAGMENT[1] == INGREDIENT[0]
