"""quarry: a PySpark library for building and checking chat-format
training datasets.

Every operator is either a ``Column`` expression (composes inside
``select``) or a ``DataFrame -> DataFrame`` function (composes with
``df.transform``).  The heavy lifting is done by built-in Spark
expressions so that plans stay inside whole-stage codegen; Python only
runs inside tasks for the optional tokenizer.
"""

__version__ = "0.1.0"

# Convenience re-exports: the operators a dataset job usually starts from.
from .functions.text import (  # noqa: E402,F401
    merge_signature, qc_signature, render_chat, strip, token_estimate, train_text,
)
from .operators.diffs import diff_lines, patch_examples  # noqa: E402,F401
from .operators.fim import fim_dedupe, fim_example, fim_spans, fim_unique  # noqa: E402,F401
from .operators.quality import (  # noqa: E402,F401
    dedupe_first, drop_report, keep_first, license_gate, qc, qc_clean, qc_groups, qc_reasons,
    qc_report, redact,
)
from .operators.segments import normalise  # noqa: E402,F401
from .operators.sessions import build_pairs, follow_windows  # noqa: E402,F401
from .operators.split import eval_size, merge_dedupe, merge_report, split, split_label  # noqa: E402,F401
from .operators.stats import length_stats  # noqa: E402,F401
from .session import ensure_checkpoint_dir, local_session, materialize  # noqa: E402,F401
from .sources.jsonl import load_dataset, read_chat, read_chat_many, read_examples, read_logs  # noqa: E402,F401
from .sources.sinks import write_chat, write_examples, write_split  # noqa: E402,F401
