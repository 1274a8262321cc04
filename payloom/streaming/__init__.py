from payloom.streaming.incremental import drop_repeats, load_stream, run_available
