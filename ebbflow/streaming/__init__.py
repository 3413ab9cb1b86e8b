from ebbflow.streaming.score_stream import start_scoring_stream  # noqa: F401
