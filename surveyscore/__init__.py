"""Survey scoring on Spark: filter, de-duplicate, decode, score and report phone-survey calls."""

from surveyscore.operators.decode import Arm, Codebook, Recode, Spelling  # noqa: F401
from surveyscore.operators.scoring import score_all, score_rounds, score_scope  # noqa: F401
from surveyscore.plans.run import run, score_responses  # noqa: F401
from surveyscore.plans.rounds import build_round, build_rounds  # noqa: F401
from surveyscore.plans.spec import Branch, Registry, StateRoundSpec  # noqa: F401
