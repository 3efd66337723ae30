"""Column -> Column helpers. Every function returns a built-in Spark expression."""

from indicatormart.functions.text import *  # noqa: F401,F403
from indicatormart.functions.numbers import *  # noqa: F401,F403
from indicatormart.functions.periods import *  # noqa: F401,F403
from indicatormart.functions.keys import *  # noqa: F401,F403
