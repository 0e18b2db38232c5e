"""Standard names from any number of rules, compiled to one prefix tree."""

from __future__ import annotations

import sys
from collections.abc import Iterable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

# Functions of this module travel with the job, so executors need no copy of it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Keys of a node beside letters: the rule that ends here; the node behind white space; and that white space stays at this node.
NAME, GAP, SKIP = 0, 1, 2


class NameTable:
    """Rules (beginning, standard name), of which the first that fits a name gives its standard name.

    A beginning fits in any case of ASCII letters; where it has white space, the name may have any amount of it, or none. So
    ``("lions gate", "Lions Gate Films")`` is what the pattern ``(?i)^lions\\s*gate`` says. The tree is walked once for a name however
    many rules there are, and equal names of a batch are walked once.
    """

    def __init__(self, rules: Iterable[tuple[str, str]]) -> None:
        self.names: list[str] = []
        self.root: dict = {}
        for beginning, name in rules:
            parts = _lower(beginning).split()
            if not parts:
                raise ValueError(f"a rule needs a beginning: {(beginning, name)}")
            node = self.root
            for k, part in enumerate(parts):
                node = node.setdefault(GAP, {SKIP: True}) if k else node
                for letter in part:
                    node = node.setdefault(letter, {})
            node.setdefault(NAME, len(self.names))
            self.names.append(name)

    def standard(self, name: str) -> str:
        """The standard name, or the name itself."""
        best = len(self.names)
        live = [self.root]
        for letter in _lower(name):
            space = letter in SPACE
            live = [n[letter] for n in live if letter in n] + [n for n in live if space and SKIP in n]
            live += [n[GAP] for n in live if GAP in n]
            best = min([best, *(n[NAME] for n in live if NAME in n)])
            if not live:
                break
        return self.names[best] if best < len(self.names) else name

    def apply(self, values: pa.Array) -> pa.Array:
        """Standard names of a column of names, or of lists of them; NULL stays."""
        if pa.types.is_list(values.type):
            flat = self.apply(values.flatten())
            lengths = pc.fill_null(pc.list_value_length(values), 0).to_pylist()
            ends = [0]
            for n in lengths:
                ends.append(ends[-1] + n)
            offsets = pa.array([None if null else at for at, null in zip(ends, values.is_null().to_pylist())] + ends[-1:], pa.int32())
            return pa.ListArray.from_arrays(offsets, flat)
        coded = values.dictionary_encode()
        made = pa.array([self.standard(x) for x in coded.dictionary.to_pylist()], pa.string())
        return made.take(coded.indices)


SPACE = " \t\n\x0b\f\r"
_UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def _lower(text: str) -> str:
    return text.translate(_UPPER)


def standardise_by_table(c: Column, table: NameTable, lists: bool = False) -> Column:
    """Standard names of a text column, or with ``lists`` of a column of text arrays. The plan has one node for any number of rules."""
    return F.arrow_udf(lambda x: table.apply(x), "array<string>" if lists else "string")(c)
