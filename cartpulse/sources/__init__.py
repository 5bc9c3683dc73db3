"""Sources and sinks: JSON topics and files, serving tables, changelogs."""
