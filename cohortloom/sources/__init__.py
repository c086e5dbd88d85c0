from cohortloom.sources.readers import *  # noqa: F401,F403
from cohortloom.sources.writers import *  # noqa: F401,F403
