"""sieveflow: Spark-native message ingest and deduplication.

The main entry points, re-exported::

    from sieveflow import normalize_messages, with_fingerprint, ingest, IngestState
"""

from .operators.ingest import IngestResult, IngestState, ingest  # noqa: F401
from .operators.membership import (  # noqa: F401
    classify_against_state, content_members, filter_against_state, id_members,
)
from .operators.stats import channel_stats, run_totals, tracker_statistics  # noqa: F401
from .plans.run import RunReport, process_channels  # noqa: F401
from .sources.channels import channel_list, in_channel_order  # noqa: F401
from .sources.messages import normalize_messages, with_fingerprint  # noqa: F401
from .sources.state_store import FolderState, load_state, open_state, read_log  # noqa: F401
from .session import checkpoint_root, clear_scratch, local_session  # noqa: F401
from .streaming.ingest_stream import ingest_batch, start_ingest_stream  # noqa: F401
