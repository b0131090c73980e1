"""windrow: event-stream analytics as plain PySpark DataFrame operators.

Every operator is a function from DataFrame to DataFrame. Unless its docstring says otherwise it
accepts batch and streaming input alike and adds nothing but built-in column expressions,
aggregations, joins and windows to the plan.
"""
