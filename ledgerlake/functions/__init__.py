"""Scalar functions (Column -> Column) and their SQL registrations."""
from ledgerlake.functions.scalars import *  # noqa: F401,F403
