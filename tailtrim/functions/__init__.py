"""Column expressions shared by the operators."""

from tailtrim.functions.literals import literal_rows
from tailtrim.functions.predicates import at_or_above, below_or_missing, name_like

__all__ = ["at_or_above", "below_or_missing", "literal_rows", "name_like"]
