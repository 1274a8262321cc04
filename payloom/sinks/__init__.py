from payloom.sinks.tables import drop_tables, stamp_lineage, write_all, write_table
