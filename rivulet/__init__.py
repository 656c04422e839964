"""Dataflow operators as Spark DataFrame transformations."""

from .functions import *  # noqa: F401,F403
from .operators import *  # noqa: F401,F403
from .session import build_session, written  # noqa: F401
from .sources import *  # noqa: F401,F403
