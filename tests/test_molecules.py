"""Columns from SMILES, formulas and rings."""

import pytest
from pyspark.sql import functions as F

from qaprep.functions import rings as R
from qaprep.functions import smiles as S
from qaprep.plans import question_sets as Q


def test_counts(evaluate):
    texts = ["CCO", "[NH4+]", "[O-][N+](=O)O", "C[NH3+]", "FCNOPSCl", "c1ccccc1", "[2H]C", "[Cu+2]", "C(", "[13CH3]Cl", "[se]1cccc1", ""]
    assert evaluate(S.heavy_atom_count, texts) == [3, 1, 4, 2, 7, 6, 1, 1, 0, 2, 5, 0]
    carbon = evaluate(lambda c: S.element_count(c, "C"), texts)
    assert carbon == [2, 0, 0, 1, 1, 6, 1, 0, 0, 1, 4, 0]
    assert evaluate(lambda c: S.element_count(c, "S"), ["CS", "[Si]", "[se]", "[Se]", "c1ccsc1", "[SH2]"]) == [1, 0, 0, 0, 1, 1]
    assert evaluate(lambda c: S.element_count(c, "N"), ["[nH]1cccc1", "[Na+]", "N", "n1ccccc1"]) == [1, 0, 1, 1]


def test_charges(evaluate):
    got = evaluate(S.charge_counts, ["[NH4+]", "[OH-]", "[O-][N+](=O)O", "[Cu+2]", "[O--]", "C", "[Fe+++]", "[NH3+:4]C"])
    assert [(c.positive, c.negative, c.net) for c in got] == [
        (1, 0, 1), (0, 1, -1), (1, 1, 0), (1, 0, 2), (0, 1, -2), (0, 0, 0), (1, 0, 3), (1, 0, 1),
    ]


def test_bonds(evaluate):
    texts = ["CC#N", "C", "CCO", "C1CC1", "C=1CCCCC=1", "c1ccccc1", "CC.O", "[2H]C", "C(", "C%12CCC%12"]
    got = evaluate(S.bond_counts, texts)
    assert [b.all_bonds for b in got] == [2, 0, 2, 3, 6, 6, 1, 1, 0, 4]
    assert [b.double_bonds for b in got] == [0, 0, 0, 0, 1, None, 0, 0, 0, 0]
    assert [b.triple_bonds for b in got] == [1, 0, 0, 0, 0, 0, 0, 0, 0, 0]
    assert [b.non_hydrogen_bonds for b in got] == [2, 0, 2, 3, 6, 6, 1, 0, 0, 4]
    assert [b.aromatic_input for b in got] == [False] * 5 + [True] + [False] * 4


def test_rings_from_text(evaluate):
    assert evaluate(S.ring_count, ["C1CC1C1CC1", "C12CC1CC2", "C%10CC%10", "[13CH4]", "CC", "C1C"]) == [2, 2, 1, 0, 0, 0]


def test_formula(evaluate):
    assert evaluate(S.formula_counts, ["C6H12O6", "ClC", "CH3CH2OH", ""]) == [
        {"C": 6, "H": 12, "O": 6}, {"Cl": 1, "C": 1}, {"C": 2, "H": 6, "O": 1}, {},
    ]
    hill = lambda c: S.hill_formula(S.formula_counts(c), F.lit(0))
    assert evaluate(hill, ["O6H12C6", "OH2", "NaCl", "BrCCl2H"]) == ["C6H12O6", "H2O", "ClNa", "CHBrCl2"]
    assert evaluate(lambda c: S.hill_formula(S.formula_counts(c), F.lit(-2)), ["O4S"]) == ["O4S-2"]


def test_bond_table(spark):
    texts = ["CC(=O)C1CC1", "C1CC1.O", "N(C)(C)C", "C=1CC1", "C("]
    df = spark.createDataFrame(list(enumerate(texts)), "cid int, smiles string")
    rows = S.bond_table(df).collect()
    found = {i: sorted((r.a, r.b, r.bond_order, r.ring_closure) for r in rows if r.cid == i) for i in range(5)}
    assert found[0] == [(0, 1, "", False), (1, 2, "=", False), (1, 3, "", False), (3, 4, "", False), (3, 5, "", True), (4, 5, "", False)]
    assert found[1] == [(0, 1, "", False), (0, 2, "", True), (1, 2, "", False)]
    assert found[2] == [(0, 1, "", False), (0, 2, "", False), (0, 3, "", False)]
    assert (0, 2, "=", True) in found[3] and found[4] == []


def brute_chain(elements, edges):
    """Every simple path over the open carbons, the first longest one in scan order."""
    import itertools

    near = {i: [] for i in range(len(elements))}
    for a, b in edges:
        near[a].append(b)
        near[b].append(a)

    def on_cycle(a, b):
        seen, todo = {a}, [a]
        while todo:
            at = todo.pop()
            for x in near[at]:
                if {at, x} != {a, b} and x not in seen:
                    seen.add(x)
                    todo.append(x)
        return b in seen

    ring = set(itertools.chain.from_iterable(e for e in edges if on_cycle(*e)))
    usable = [i for i, e in enumerate(elements) if e == "C" and i not in ring]
    best = []

    def walk(path):
        nonlocal best
        if len(path) > len(best):
            best = list(path)
        for x in near[path[-1]]:
            if x in usable and x not in path:
                walk([*path, x])

    for start in usable:
        walk([start])
    return sorted(i + 1 for i in best)


def test_longest_chain(spark):
    texts = ["CCCC", "CC(C)CC", "C1CCCCC1CCC", "CC(CC)(CCC)CC", "CCOCCC", "c1ccccc1", "CC(=O)C(C(C)C)CC#CC", "O", "CC1CC1CCCC2CC2", "C(C)(C)C", "C("]
    df = spark.createDataFrame(list(enumerate(texts)), "cid int, smiles string")
    linked = df.select("cid", "smiles", S.atoms(F.col("smiles")).alias("e"), R.chain_bonds(F.col("smiles")).alias("k"))
    rows = linked.withColumn("chain", R.longest_chain(F.col("smiles"), F.col("k"))).orderBy("cid").collect()
    for row in rows[:-1]:
        edges = [(k.a, k.b) for k in row.k]
        assert row.chain == brute_chain(["C" if e in ("C", "c") else e for e in row.e], edges), row.smiles
    assert rows[-1].chain == []


def test_ring_arrays(spark):
    df = spark.createDataFrame([([[5, 4, 3, 2, 1, 0], [9, 4, 5, 8, 7], [20, 21, 22]], [True, False, False])], "r array<array<int>>, f array<boolean>")
    row = df.select(
        R.sort_rings(F.col("r")).alias("s"), R.sort_rings(F.col("r"), base=1).alias("s1"),
        R.ring_size_counts(F.col("r"), F.col("f")).alias("n"), R.fused_ring_count(F.col("r")).alias("fused"),
    ).first()
    assert row.s == [[0, 1, 2, 3, 4, 5], [4, 5, 7, 8, 9], [20, 21, 22]]
    assert row.s1[0] == [1, 2, 3, 4, 5, 6]
    assert (row.n.total_rings, row.n.five_membered_rings, row.n.six_membered_rings, row.n.aromatic_rings, row.n.aromatic_six_membered_rings) == (3, 1, 1, 1, 1)
    assert row.fused == 2


def test_property_set(spark):
    rows = [("CCO", "C2H6O", "ethanol"), ("CC(=O)O", "C2H4O2", None), ("C(", "CH4", "broken"), ("C", "CH4", " ")]
    df = spark.createDataFrame(rows, "smiles string, formula string, iupac string")
    got = {r.smiles: r for r in Q.question_set("molecular_properties")(df).collect()}
    assert set(got) == {"CCO", "CC(=O)O"}
    assert got["CC(=O)O"].iupac_name == "None"
    ethanol = got["CCO"]
    assert ethanol.longest_chain == '{"longest_carbon_chain": [1, 2]}'
    assert ethanol.element_counts == '{"C": 2, "N": 0, "O": 1, "P": 0, "S": 0, "Cl": 0, "F": 0}'
    assert ethanol.bond_counts == '{"all_bonds": 2, "double_bonds": 0, "triple_bonds": 0}'
    assert (ethanol.heavy_atom_count, ethanol.hydrogen_count, ethanol.molecular_formula) == ("3", "6", "C2H6O")
    with pytest.raises(ValueError):
        Q.question_set("unheard of")
    assert Q.question_set("iupac_naming")(df).count() == 2


def test_validity_and_reused_labels(evaluate):
    broken = ["C1CC2", "C)(C", "CC=", "C==C", "=C", "C()C", "C(=)C", "1CC1", "(C)C", "C.=C", "C1CC", "C(C))C", ".C"]
    assert evaluate(S.parsable, broken) == [False] * len(broken)
    sound = ["C1CC1C1CC1", "C(C)(C)C", "C=C", "C%10CC%10", "[Na+].[Cl-]", "C(=O)O", "F/C=C/F", "C1=CC=CC=C1", "C=1CCC=1C=1CCC=1"]
    assert evaluate(S.parsable, sound) == [True] * len(sound)
    counts = evaluate(S.bond_counts, ["C=1CCC=1C=1CCC=1", "C=1CCC1C=1CCC1", "C=1CCC1C1CCC=1", "C=1CC=2CC=1CC=2", "C#1CCCCC#1"])
    assert [b.double_bonds for b in counts] == [2, 2, 2, 2, 0] and counts[4].triple_bonds == 1


def test_unknown_answers_drop_the_row(spark):
    rows = [(1, "CCO", "C2H6O", "ethanol", None), (2, "c1ccccc1", "C6H6", "benzene", None), (3, "c1ccccc1", "C6H6", "benzene", "C1=CC=CC=C1"), (4, "CC", "C2H6", None, "CC")]
    df = spark.createDataFrame(rows, "cid int, smiles string, formula string, iupac string, kekulized_smiles string")
    plain = Q.molecular_properties(df.drop("kekulized_smiles"))
    assert {r.cid for r in plain.collect()} == {1, 4}
    supplied = {r.cid: r for r in Q.molecular_properties(df).collect()}
    assert set(supplied) == {3, 4} and supplied[3].kekulized_smiles == "C1=CC=CC=C1"
    assert supplied[3].bond_counts == '{"all_bonds": 6, "double_bonds": 3, "triple_bonds": 0}' and supplied[4].iupac_name == "None"


def test_a_label_closed_on_its_own_atom(evaluate):
    """An atom can't be bonded to itself; closing a ring and opening the next with one label is fine."""
    wrong = ["C11", "CC1=1C", "C%11%11", "C1CC1C11", "C12CC1C2C33"]
    right = ["C1CC11CC1", "C1CC1C1CC1", "C12CC1C2", "C1=CC=CC=1", "C%11CC%11%11CC%11", "C1C2C1C2"]
    assert evaluate(S.parsable, wrong + right) == [False] * len(wrong) + [True] * len(right)
    assert evaluate(lambda c: S.ring_count(c), ["C11", "C1CC1"]) == [0, 1]
