"""Columns computed from SMILES and formula text by scanning tokens."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaprep.functions.binding import bind

# SMILES token classes and the elements that get counted.
ATOM = r"\[[^\]]+\]|Br|Cl|[BCNOPSFI]|[bcnops]"
CLOSURE = r"%[0-9]{2}|[0-9]"
BOND = r"[-=#$:/\\]"
OTHER = r"[().]"
TOKEN = f"{ATOM}|{CLOSURE}|{BOND}|{OTHER}"
ELEMENTS = ("C", "N", "O", "P", "S", "Cl", "F")


def tokens(smiles: Column) -> Column:
    return F.regexp_extract_all(smiles, F.lit(f"({TOKEN})"), 1)


def token_kind(token: Column) -> Column:
    return (
        F.when(token.rlike(f"^({ATOM})$"), "atom")
        .when(token.rlike(f"^({CLOSURE})$"), "closure")
        .when(token.rlike(f"^{BOND}$"), "bond")
        .when(token == ".", "dot")
        .otherwise("branch")
    )


def smiles_tokens(df: DataFrame, key: str = "cid", smiles: str = "smiles") -> DataFrame:
    """(key, pos, token, kind), one row per token."""
    exploded = df.select(key, F.posexplode(tokens(F.col(smiles))).alias("pos", "token"))
    return exploded.withColumn("kind", token_kind(F.col("token")))


@dataclass(frozen=True)
class Scan:
    """A SMILES column with the two things nearly every count starts from: the text outside
    brackets, and whether the text parses."""

    text: Column
    bare: Column
    valid: Column


def scan(smiles: Column | Scan) -> Scan:
    return smiles if isinstance(smiles, Scan) else Scan(smiles, _without_brackets(smiles), parsable(smiles))


def with_scan(df: DataFrame, smiles: str = "smiles") -> tuple[DataFrame, Scan]:
    """Attach them as columns, so that any number of counts works them out once."""
    found = scan(F.col(smiles))
    table = df.withColumns({"_bare": found.bare, "_valid": found.valid})
    return table, Scan(F.col(smiles), F.col("_bare"), F.col("_valid"))


SCAN_COLUMNS = ("_bare", "_valid")


def _without_brackets(smiles: Column) -> Column:
    return F.regexp_replace(smiles, r"\[[^\]]*\]", "")


def _occurrences(text: Column, mark: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(mark)))) / F.lit(len(mark))


def _closure_labels(bare: Column) -> Column:
    """Ring-closure labels; each closure is written at both of its ends."""
    return F.regexp_count(bare, F.lit(CLOSURE))


# What may not stand side by side, on the text with A for an atom, 1 for a closure, = for a bond sign: nothing
# but an atom ahead of the first bond, closure, branch or dot; no bond sign without a partner behind it.
_OUT_OF_PLACE = r"^[^A]|=[=().]|=$|\([().1]|\.[=1().]|\($"


def _closures(bare: Column) -> Column:
    """Ring closures in the order they are written, each with the bond sign ahead of it, if there is one."""
    return F.regexp_extract_all(bare, F.lit(f"({BOND}?(?:{CLOSURE}))"), 1)


def _label(closure: Column) -> Column:
    return F.regexp_replace(closure, f"^{BOND}", "")


def _closes_on_itself(bare: Column) -> Column:
    """Whether an atom opens and closes the same ring label. Runs of closures that repeat a label are rare; only
    with one in sight are the labels counted: one that is open before the run is closed and opened anew."""
    one = f"{BOND}?(?:{CLOSURE})"
    labels = lambda run: F.transform(F.regexp_extract_all(run, F.lit(f"({one})"), F.lit(1)), _label)
    written = lambda items, label: F.size(F.filter(items, lambda x: x == label))

    def own(runs: Column) -> Column:
        before = lambda i: F.flatten(F.slice(runs, F.lit(1), i))
        closed = F.transform(runs, lambda run, i: F.exists(run, lambda x: (written(run, x) > 1) & (written(before(i), x) % 2 == 0)))
        return F.exists(closed, lambda c: c)

    found = bind(F.transform(F.regexp_extract_all(bare, F.lit(f"((?:{one})+)"), F.lit(1)), labels), own)
    return F.when(bare.rlike(rf"({CLOSURE})(?:{one})*?{BOND}?\1"), found).otherwise(F.lit(False))


def parsable(smiles: Column) -> Column:
    """No text left over beside the tokens, every token in place, branches closed after they were opened,
    every ring-closure label written an even number of times (a label may be used again), but not opened and
    closed at one atom."""
    left_over = F.regexp_replace(smiles, TOKEN, "")
    bare = _without_brackets(smiles)
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(smiles, ATOM, "A"), CLOSURE, "1"), BOND, "=")
    steps = F.split(F.regexp_replace(bare, r"[^()]", ""), "")
    depth = lambda d, c: F.when(d < 0, d).when(c == "(", d + 1).when(c == ")", d - 1).otherwise(d)
    # branches closed: the depth never falls below zero and ends there
    closed = F.when(~bare.rlike("[()]"), True).otherwise(F.aggregate(steps, F.lit(0), depth) == 0)
    labels = F.transform(_closures(bare), _label)
    even = lambda label: F.size(F.filter(labels, lambda x: x == label)) % 2 == 0
    paired = F.when(_closure_labels(bare) == 0, True).otherwise(F.forall(F.array_distinct(labels), even))
    return F.coalesce((smiles != "") & (left_over == "") & ~kinds.rlike(_OUT_OF_PLACE) & closed & paired & ~_closes_on_itself(bare), F.lit(False))


def atoms(smiles: Column) -> Column:
    """Atom tokens in order; their position is the atom index."""
    return F.regexp_extract_all(smiles, F.lit(f"({ATOM})"), 1)


def _valid_or_zero(smiles: Scan, value: Column) -> Column:
    return F.when(smiles.valid, value).otherwise(F.lit(0)).cast("bigint")


def _element_atoms(smiles: Scan, element: str) -> Column:
    """Atoms of one element, inside and outside brackets; one-letter elements may be aromatic."""
    forms = element if len(element) > 1 else f"(?:{element}|{element.lower()})"
    bare = f"{forms}(?!l)" if element == "C" else forms
    return F.regexp_count(smiles.bare, F.lit(bare)) + F.regexp_count(
        smiles.text, F.lit(rf"\[[0-9]*{forms}(?![a-z])[^\]]*\]")
    )


def _hydrogen_atoms(smiles: Column) -> Column:
    """Hydrogens written as atoms of their own, such as ``[2H]``."""
    return F.regexp_count(smiles, F.lit(r"\[[0-9]*H(?![a-z])[^\]]*\]"))


def _atom_tokens(smiles: Column) -> Column:
    return F.regexp_count(smiles, F.lit(ATOM))


def element_count(smiles: Column | Scan, element: str) -> Column:
    smiles = scan(smiles)
    return _valid_or_zero(smiles, _element_atoms(smiles, element))


def element_counts(smiles: Column | Scan) -> Column:
    """Counts of the listed elements as a struct."""
    return F.struct(*[element_count(smiles, e).alias(e) for e in ELEMENTS])


def heavy_atom_count(smiles: Column | Scan) -> Column:
    smiles = scan(smiles)
    return _valid_or_zero(smiles, _atom_tokens(smiles.text) - _hydrogen_atoms(smiles.text))


def atom_charges(smiles: Column) -> Column:
    """Formal charge of every charged atom: ``+``, ``--``, ``+2`` and ``-3`` are all accepted."""
    written = F.regexp_extract_all(smiles, F.lit(r"([+-]+[0-9]*)(?::[0-9]+)?\]"), 1)

    def charge(text: Column) -> Column:
        digits = F.regexp_extract(text, "([0-9]+)$", 1)
        amount = F.when(digits == "", F.length(text)).otherwise(digits.try_cast("int"))
        return F.when(F.startswith(text, F.lit("-")), -amount).otherwise(amount)

    return F.transform(written, charge)


def charge_counts(smiles: Column | Scan) -> Column:
    """Atoms with positive and negative charge, and the net charge."""
    smiles = scan(smiles)
    charges = atom_charges(smiles.text)
    return F.struct(
        _valid_or_zero(smiles, F.size(F.filter(charges, lambda c: c > 0))).alias("positive"),
        _valid_or_zero(smiles, F.size(F.filter(charges, lambda c: c < 0))).alias("negative"),
        _valid_or_zero(smiles, F.aggregate(charges, F.lit(0), lambda a, c: a + c)).alias("net"),
    )


def _fragments(bare: Column) -> Column:
    return _occurrences(bare, ".").cast("int") + 1


def is_aromatic_text(smiles: Column | Scan) -> Column:
    """Lower-case atoms: the text is not in Kekule form."""
    smiles = scan(smiles)
    return smiles.bare.rlike("[bcnops]") | smiles.text.rlike(r"\[[0-9]*[a-z]")


def ring_count(smiles: Column | Scan) -> Column:
    """Cycle rank: every ring closure adds one ring."""
    smiles = scan(smiles)
    return _valid_or_zero(smiles, F.floor(_closure_labels(smiles.bare) / 2))


def _written_bonds(bare: Column, sign: str) -> Column:
    """Bonds written with ``sign``; one that is written at both ends of a closure counts once. The first and
    the second writing of a label are the ends of one closure, the third and the fourth of the next."""
    closures = _closures(bare)
    signed = F.regexp_count(bare, F.lit(f"{sign}(?:{CLOSURE})"))

    def repeated(label: Column) -> Column:
        own = F.filter(closures, lambda c: _label(c) == label)
        marked = F.transform(own, lambda c: F.startswith(c, F.lit(sign)).cast("int"))
        both = F.transform(marked, lambda m, i: F.when(i % 2 == 1, m * F.get(marked, i - 1)).otherwise(0))
        return F.aggregate(both, F.lit(0), lambda a, b: a + b)

    labels = F.array_distinct(F.transform(closures, _label))
    twice = F.aggregate(F.transform(labels, repeated), F.lit(0), lambda a, b: a + b)
    return _occurrences(bare, sign) - F.when(signed > 1, twice).otherwise(0)


def bond_counts(smiles: Column | Scan) -> Column:
    """All, double and triple bonds and bonds between heavy atoms. The number of double bonds of a
    text with aromatic atoms is not known without perception: it is null then and flagged."""
    smiles = scan(smiles)
    n_atoms = _atom_tokens(smiles.text)
    n_heavy = n_atoms - _hydrogen_atoms(smiles.text)
    links = F.floor(_closure_labels(smiles.bare) / 2) - _fragments(smiles.bare)
    aromatic = smiles.valid & is_aromatic_text(smiles)
    doubles = F.when(~aromatic, _valid_or_zero(smiles, _written_bonds(smiles.bare, "=")))
    return F.struct(
        _valid_or_zero(smiles, n_atoms + links).alias("all_bonds"),
        doubles.alias("double_bonds"),
        _valid_or_zero(smiles, _written_bonds(smiles.bare, "#")).alias("triple_bonds"),
        _valid_or_zero(smiles, F.greatest(n_heavy + links, F.lit(0))).alias("non_hydrogen_bonds"),
        aromatic.alias("aromatic_input"),
    )


FORMULA_PART = r"([A-Z][a-z]?)([0-9]*)"


def formula_counts(formula: Column) -> Column:
    """Element -> count map of a formula; an element that is written twice is added up."""
    names = F.regexp_extract_all(formula, F.lit(FORMULA_PART), 1)
    numbers = F.regexp_extract_all(formula, F.lit(FORMULA_PART), 2)
    pairs = F.zip_with(
        names, numbers, lambda n, c: F.struct(n.alias("e"), F.when(c == "", F.lit(1)).otherwise(c.try_cast("int")).alias("n"))
    )
    kind = "array<struct<e:string,n:int>>"

    def add(done: Column, pair: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        summed = F.struct(pair["e"].alias("e"), (last["n"] + pair["n"]).alias("n"))
        before = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        repeated = F.coalesce(last["e"] == pair["e"], F.lit(False))
        return F.when(repeated, F.array_append(before, summed)).otherwise(F.array_append(done, pair)).cast(kind)

    return F.map_from_entries(F.aggregate(F.array_sort(pairs).cast(kind), F.array().cast(kind), add))


def hydrogen_count(formula: Column) -> Column:
    return F.coalesce(F.try_element_at(formula_counts(formula), F.lit("H")), F.lit(0)).cast("bigint")


def hill_formula(counts: Column, net_charge: Column | None = None) -> Column:
    """Formula text in Hill order: with carbon C, H, then the alphabet; without it the alphabet."""
    def listed(place: Callable[[Column], Column]) -> Column:
        keyed = lambda p: F.struct(place(p["key"]).alias("o"), p["key"].alias("e"), p["value"].alias("n"))
        return F.array_sort(F.transform(F.map_entries(counts), keyed))

    organic = listed(lambda e: F.when(e == "C", 0).when(e == "H", 1).otherwise(2))
    entries = F.when(F.map_contains_key(counts, F.lit("C")), organic).otherwise(listed(lambda e: F.lit(2)))
    part = lambda p: F.concat(p["e"], F.when(p["n"] == 1, "").otherwise(p["n"].cast("string")))
    text = F.array_join(F.transform(entries, part), "")
    if net_charge is None:
        return text
    size = F.when(F.abs(net_charge) == 1, "").otherwise(F.abs(net_charge).cast("string"))
    return F.when(net_charge == 0, text).otherwise(
        F.concat(text, F.when(net_charge > 0, "+").otherwise("-"), size)
    )


_STATE = (
    "struct<n:int,last:int,sign:string,stack:array<int>,"
    "open:array<struct<label:string,atom:int,sign:string>>,"
    "bonds:array<struct<a:int,b:int,bond_order:string,ring_closure:boolean>>>"
)


def bonds(smiles: Column) -> Column:
    """Bonds (a, b, bond_order, ring_closure) by zero-based atom index.

    One left fold over the tokens of a row: the state holds the atom to bond to, the open
    branches and the open ring closures. Nothing is shuffled.
    """

    def state(s: Column, **changes: Column) -> Column:
        names = ("n", "last", "sign", "stack", "open", "bonds")
        return F.struct(*[changes.get(n, s[n]).alias(n) for n in names]).cast(_STATE)

    def bond(a: Column, b: Column, sign: Column, closing: bool) -> Column:
        return F.struct(a.alias("a"), b.alias("b"), sign.alias("bond_order"), F.lit(closing).alias("ring_closure"))

    def step(s: Column, t: Column) -> Column:
        partner = F.filter(s["open"], lambda o: o["label"] == t)
        signed = lambda o: F.when(s["sign"] != "", s["sign"]).otherwise(o["sign"])
        close = state(
            s,
            sign=F.lit(""),
            open=F.filter(s["open"], lambda o: o["label"] != t),
            bonds=F.concat(s["bonds"], F.transform(partner, lambda o: bond(o["atom"], s["last"], signed(o), True))),
        )
        opened = F.struct(t.alias("label"), s["last"].alias("atom"), s["sign"].alias("sign"))
        open_ = state(s, sign=F.lit(""), open=F.array_append(s["open"], opened))
        linked = F.array_append(s["bonds"], bond(s["last"], s["n"], s["sign"], False))
        atom = state(
            s,
            n=s["n"] + 1,
            last=s["n"],
            sign=F.lit(""),
            bonds=F.when(s["last"] >= 0, linked).otherwise(s["bonds"]),
        )
        kind = token_kind(t)
        return (
            F.when(t == "(", state(s, stack=F.array_append(s["stack"], s["last"])))
            .when(
                t == ")",
                state(
                    s,
                    last=F.coalesce(F.try_element_at(s["stack"], F.lit(-1)), F.lit(-1)),
                    sign=F.lit(""),
                    stack=F.slice(s["stack"], F.lit(1), F.greatest(F.size(s["stack"]) - 1, F.lit(0))),
                ),
            )
            .when(kind == "dot", state(s, last=F.lit(-1), sign=F.lit("")))
            .when(kind == "bond", state(s, sign=t))
            .when((kind == "closure") & (F.size(partner) > 0), close)
            .when(kind == "closure", open_)
            .otherwise(atom)
        )

    start = F.struct(
        F.lit(0).alias("n"),
        F.lit(-1).alias("last"),
        F.lit("").alias("sign"),
        F.array().alias("stack"),
        F.array().alias("open"),
        F.array().alias("bonds"),
    ).cast(_STATE)
    return F.aggregate(tokens(smiles), start, step, lambda s: s["bonds"])


def bond_table(df: DataFrame, key: str = "cid", smiles: str = "smiles") -> DataFrame:
    """(key, a, b, bond_order, ring_closure); rows that do not parse have no bonds."""
    found = df.filter(parsable(F.col(smiles))).select(key, bonds(F.col(smiles)).alias("_bonds"))
    return found.select(key, F.inline("_bonds"))
