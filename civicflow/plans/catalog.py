"""All registered queries: ``SPARK[name](spark, sf_dir)`` and ``SQL[name]``.

Every entry reads the whole fixture tables of ``sf_dir`` through a binding and
runs one operator of the library over all of it.
"""

from __future__ import annotations

from . import reg_queries  # noqa: F401  (Q1-Q7)
from .registry import SPARK, SQL  # noqa: F401
from . import reg_cleaning  # noqa: F401,E402  (P1-P23, IO6, IO7)
from . import reg_explore  # noqa: F401,E402  (A1-A19)
from . import reg_diagnostics  # noqa: F401,E402  (D1-D5)
from . import reg_model  # noqa: F401,E402  (M1-M15)
