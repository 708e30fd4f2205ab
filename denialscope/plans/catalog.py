"""Imports every query module so their ``register`` calls run (order
matters: composite oracles reuse the SQL of earlier registrations; the
long-running model-training queries are registered last)."""

from . import q_core  # noqa: F401
from . import q_kpis  # noqa: F401
from . import q_eval  # noqa: F401
from . import q_explain  # noqa: F401
from . import q_io  # noqa: F401
from . import q_stream  # noqa: F401
from . import q_dash  # noqa: F401
from . import q_dims  # noqa: F401
from . import q_layout  # noqa: F401
from . import q_train  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
