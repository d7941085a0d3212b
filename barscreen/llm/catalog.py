"""What the entry file adds when this subpackage is present."""

from barscreen.llm.queries import ORACLES, QUERIES  # noqa: F401
