"""Connected components; they live with the other operators."""

from quern.operators.components import components  # noqa: F401
