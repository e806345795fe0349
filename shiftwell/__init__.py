"""Driver wellbeing analytics on Spark."""

import sys

from pyspark import cloudpickle

# Tasks get the package's functions with their code, so it need not be installed
# where they run.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from shiftwell.operators.answers import AnswerStore  # noqa: E402
from shiftwell.operators.checks import LoadReport, RejectedRows  # noqa: E402
from shiftwell.operators.inference import Question, embed, generate, results  # noqa: E402
from shiftwell.operators.layout import layout_2d  # noqa: E402
from shiftwell.operators.models import BatchModel, ColumnModel  # noqa: E402
from shiftwell.operators.projection import crowded_bins, point_bins, project_2d  # noqa: E402
from shiftwell.plans.articles import articles_metrics  # noqa: E402
from shiftwell.plans.drivers import drivers_metrics_core, summary_drivers  # noqa: E402
from shiftwell.plans.embeddings import (  # noqa: E402
    driver_reason_embeddings,
    embedding_point_bins,
    embedding_points,
)
from shiftwell.plans.run import Models, build_marts, run_all  # noqa: E402
from shiftwell.plans.stress import driver_reason_tags, drivers_metrics  # noqa: E402
from shiftwell.session import build_session  # noqa: E402
from shiftwell.sources.feeds import load_feed  # noqa: E402
from shiftwell.sources.tables import append_literals, append_rows, upload_csv  # noqa: E402
from shiftwell.streaming.append import append_feed, append_stream, read_appended  # noqa: E402
from shiftwell.streaming.days import DayStates  # noqa: E402
from shiftwell.workspace import Workspace  # noqa: E402

__all__ = [
    "AnswerStore",
    "BatchModel",
    "ColumnModel",
    "DayStates",
    "LoadReport",
    "Models",
    "Question",
    "RejectedRows",
    "Workspace",
    "append_feed",
    "append_literals",
    "append_rows",
    "append_stream",
    "articles_metrics",
    "build_marts",
    "build_session",
    "crowded_bins",
    "driver_reason_embeddings",
    "driver_reason_tags",
    "drivers_metrics",
    "drivers_metrics_core",
    "embed",
    "embedding_point_bins",
    "embedding_points",
    "generate",
    "layout_2d",
    "load_feed",
    "point_bins",
    "project_2d",
    "read_appended",
    "results",
    "run_all",
    "summary_drivers",
    "upload_csv",
]
