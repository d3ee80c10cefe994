"""Structured Streaming: mention and phrase alerts (T1), per-window counts."""

from reelscope.streaming.mentions import (mention_alerts, mentions_per_window, read_alert_sink,
                                          read_phrase_alert_sink, read_window_sink,
                                          run_alert_stream, run_phrase_alert_stream,
                                          run_window_stream, stream_events)

__all__ = ["mention_alerts", "mentions_per_window", "read_alert_sink", "read_phrase_alert_sink",
           "read_window_sink", "run_alert_stream", "run_phrase_alert_stream", "run_window_stream",
           "stream_events"]
