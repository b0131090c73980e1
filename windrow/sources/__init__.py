"""Sources: behaviour logs, topic messages, text lines."""
