"""Pure DataFrame operators: change-log reads and diffs, DML, ids, rules, recovery, layout, governance, checks."""
