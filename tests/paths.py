"""Names that tests import; ``conftest`` modules hold fixtures only, since there is one in each test folder."""

import os

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    """Executed (adaptive, final) physical plan text, without the initial plan."""
    df.collect()
    s = df._jdf.queryExecution().executedPlan().toString()
    return s.split("== Initial Plan ==")[0]
