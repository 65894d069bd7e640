"""tabloom: PySpark operators for QA sample building, table profiling, text
preparation, tabular models, evaluation and sequence-tag scoring."""
