"""hrforge: HR, leave and payroll analytics as Spark DataFrame operators.

Every operator is a plain function from DataFrames to DataFrames. Procedures that
change table state in the original design return the *new snapshot* (or the rows to
append); nothing is updated in place. ``as_of`` replaces every reading of the clock.
"""

from hrforge.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
