from cohortloom.functions.exprs import *  # noqa: F401,F403
from cohortloom.functions.predicates import *  # noqa: F401,F403
