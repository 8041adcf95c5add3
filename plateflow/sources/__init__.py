"""Where payloads and events come from and go to."""
