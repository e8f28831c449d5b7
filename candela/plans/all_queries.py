"""Import every query module so that it registers in ``catalog.REGISTRY``."""

from candela.plans import catalog  # noqa: F401
from candela.plans import q_features  # noqa: F401
from candela.plans import q_strategy  # noqa: F401
from candela.plans import q_analytics  # noqa: F401
from candela.plans import q_misc  # noqa: F401
from candela.plans import q_portfolio  # noqa: F401
from candela.plans import q_ml_stream  # noqa: F401
from candela.plans import q_trees  # noqa: F401

REGISTRY = catalog.REGISTRY
flagship = catalog.flagship
