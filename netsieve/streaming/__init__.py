"""Structured Streaming over arriving files: micro-batches of n files, per-batch results
written idempotently by batch id, and statistics merged across batches or kept in the state
store."""

from .batches import (batch_moments, merged_moments, stream_file_batches, stream_fit_snapshots,
                      stream_nb_update)
from .online import OnlineLogistic, online_predictions, read_online, stream_logistic_online
from .state import nb_model, read_moments, stream_nb_state

__all__ = ["OnlineLogistic", "batch_moments", "merged_moments", "nb_model", "online_predictions", "read_moments",
           "read_online", "stream_file_batches", "stream_fit_snapshots", "stream_logistic_online", "stream_nb_state",
           "stream_nb_update"]
