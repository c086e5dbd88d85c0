from cohortloom.operators.aggregates import *  # noqa: F401,F403
from cohortloom.operators.checks import *  # noqa: F401,F403
from cohortloom.operators.joins import *  # noqa: F401,F403
from cohortloom.operators.ordering import *  # noqa: F401,F403
from cohortloom.operators.ranges import *  # noqa: F401,F403
from cohortloom.operators.selection import *  # noqa: F401,F403
from cohortloom.operators.subjects import *  # noqa: F401,F403
