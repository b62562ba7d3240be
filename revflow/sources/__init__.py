"""Sources and sinks: file feeds, versioned tables, and the CRM feed shapes."""
