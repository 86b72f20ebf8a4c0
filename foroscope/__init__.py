"""Forum, chat-log and contact-record analytics as Spark DataFrame functions."""
