"""Environmental and official statistics as Spark DataFrame operators.

Every operator takes DataFrames and returns DataFrames: nothing is collected on the driver, thresholds
are parameters, and what a rule leaves out is returned next to what it keeps.
"""

from tidemark.session import build_session

__all__ = ["build_session"]
