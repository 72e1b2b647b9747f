from tickwise.functions.scalar import *  # noqa: F401,F403
from tickwise.functions.arrays import *  # noqa: F401,F403
