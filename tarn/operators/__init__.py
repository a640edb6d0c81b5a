"""``DataFrame -> DataFrame`` operators."""

from tarn.operators.catalog import catalogue, dictionary, structure
from tarn.operators.conform import conform, normalize
from tarn.operators.control import volume
from tarn.operators.gates import EmptyLayer, require_count, require_layer, require_rows, shape
from tarn.operators.profile import profile
from tarn.operators.rollup import count_by, count_by_sql, ranked, stamped, top

__all__ = [
    "EmptyLayer",
    "catalogue",
    "conform",
    "count_by",
    "count_by_sql",
    "dictionary",
    "normalize",
    "profile",
    "ranked",
    "require_count",
    "require_layer",
    "require_rows",
    "shape",
    "stamped",
    "structure",
    "top",
    "volume",
]
