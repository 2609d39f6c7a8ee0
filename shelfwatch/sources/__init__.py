"""Landing replies, staging text files and the warehouse tables."""
