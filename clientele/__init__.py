"""clientele — customer and campaign analytics expressed as Spark DataFrame operators.

Every public operator takes a DataFrame (plus parameters) and returns a
DataFrame or a Column expression, so a whole analysis stays one lazy plan that
Catalyst can prune, push down and fuse.  The few places that need an action
(exact order statistics, model fitting) say so in their docstrings.
"""

from clientele.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
