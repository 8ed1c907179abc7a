"""tokloom: a Spark-native corpus preparation engine.

Chat and document tables are flattened into tagged text, pre-tokenised with a
Unicode-aware pattern, counted, used to train a byte-pair-encoding merge table,
encoded into token streams and packed into fixed-length training windows --
all as lazy DataFrame plans that Catalyst optimises and Spark distributes.
"""

from tokloom.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
