"""Where messages and tables come from, and the options of the message broker."""
