from payloom.sources.bronze import read_bronze, scope_filter, select_element, window_filter
