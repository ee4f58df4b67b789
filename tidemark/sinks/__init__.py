"""Writers for warehouse tables, delimited text and relational targets."""
